"""Queries on sources, filters and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkloom.constants import BLOCKLIST
from linkloom.operators import filters, lookups, sampling
from linkloom.registry.base import (
    LABELS,
    ORACLES,
    SQL_LINKS,
    SQL_RESULTS,
    SQL_SEEDS,
    SQL_TEXTS,
    label_of,
    link_table,
    query,
    result_table,
    seed_table,
    sql_label,
    sql_netloc,
    sql_values,
    table,
    text_table,
)
from linkloom.session import shared_path
from linkloom.sinks import files
from linkloom.sources import dumps, seeds as seed_sources
from linkloom.streaming import ingest, merge

# The default list, and entries that occur in the hosts and paths at hand.
BLOCKED = [*BLOCKLIST, "cheap-pills", "spam-farm", "utm_", "/9"]
# Entries that block nothing here and make a list too long for literals.
UNUSED = [f"no-such-site-{i}.example" for i in range(501)]
EXCLUDED = ["eng_Latn", "deu_Latn"]
SQL_BLOCKLIST = sql_values("blocklist", "entry", [(e,) for e in BLOCKED])
_NOT_BLOCKED = "NOT EXISTS (SELECT 1 FROM blocklist WHERE contains({}, entry))"


# Sources.
@query(
    "seed_query_slice",
    f"""SELECT item_id AS line_no, {sql_label("['en', 'fr', 'de', 'es'][item_id % 4 + 1]")} AS iso_code, text AS query
    FROM (SELECT item_id, regexp_replace(text, '[\\t\\n]', ' ', 'g') AS text FROM benchmark)
      WHERE item_id >= 5 AND item_id < (SELECT max(item_id) - 5 FROM benchmark)""",
)
def seed_query_slice(spark, sf_dir):
    end = table(spark, sf_dir, "benchmark").agg(F.max("item_id") - 5).first()[0]
    return seed_sources.split_query_lines(_query_lines(spark, sf_dir), 5, end)


def _query_lines(spark, sf_dir):
    """(line_no, value): the benchmark items as tab-separated lines."""
    items = table(spark, sf_dir, "benchmark")
    iso = F.get(F.array(*[F.lit(v) for v in LABELS.values()]), F.col("item_id") % 4)
    flat = F.regexp_replace("text", r"[\t\n]", " ")
    return items.select(F.col("item_id").alias("line_no"), F.concat(iso, F.lit("\t"), flat, F.lit("\n")).alias("value"))


@query(
    "search_dump_explode",
    f"""WITH {SQL_RESULTS}, keyed AS (SELECT *, iso_code || CASE WHEN pos % 2 = 0 THEN '' ELSE 'x' END AS code FROM results)
    SELECT code AS iso_code, line_no, row_number() OVER (PARTITION BY line_no, code ORDER BY pos) - 1 AS pos, link, snippet FROM keyed""",
)
def search_dump_explode(spark, sf_dir):
    return _numbered(seed_sources.explode_dump(_dumps(spark, sf_dir)))


@query("search_dump_split", ORACLES["search_dump_explode"])
def search_dump_split(spark, sf_dir):
    """The same dumps in files, split at braces."""
    path = shared_path(spark, "dumps")
    _dumps(spark, sf_dir).write.text(path)
    return _numbered(dumps.read_split_dump(spark, path))


def _dumps(spark, sf_dir):
    """A dump object for each query, with two keys and several results under each."""
    rows = result_table(spark, sf_dir)
    code = F.concat("iso_code", F.when(F.col("pos") % 2 == 0, "").otherwise("x"))
    results = F.transform(F.sort_array(F.collect_list(F.struct("pos", "link", "snippet"))), lambda r: F.struct(r["link"].alias("link"), r["snippet"].alias("snippet"), F.lit("t").alias("title"), F.array(F.lit("e")).alias("engines")))
    keyed = rows.groupBy("line_no", code.alias("code")).agg(results.alias("results"))
    return keyed.groupBy("line_no").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("code", "results")))).alias("value")).select("value")


def _numbered(found):
    # The query's number is part of its links.
    return found.select("iso_code", F.regexp_extract("link", "q([0-9]+)", 1).cast("bigint").alias("line_no"), "pos", "link", "snippet")


@query(
    "search_merge_last",
    f"""WITH {SQL_RESULTS} SELECT iso_code, line_no, pos, link FROM results r
    WHERE line_no = (SELECT max(line_no) FROM results m WHERE m.iso_code = r.iso_code)""",
)
def search_merge_last(spark, sf_dir):
    return seed_sources.merge_last(result_table(spark, sf_dir).select("iso_code", "line_no", "pos", "link"))


@query(
    "search_merge_append",
    f"""WITH {SQL_RESULTS} SELECT r.iso_code, r.link, q.snippet AS query FROM results r
    JOIN results q ON q.line_no = r.line_no AND q.pos = 0""",
)
def search_merge_append(spark, sf_dir):
    rows = result_table(spark, sf_dir)
    asked = rows.filter(F.col("pos") == 0).select("line_no", F.col("snippet").alias("query"))
    half = F.contains("link", F.lit("1.example"))
    batches = [rows.filter(half), rows.filter(~half)]
    return seed_sources.merge_append(batches, asked).select("iso_code", "link", "query")


def _merged_stream(spark, sf_dir, rule):
    """Three batches, each by a query started anew; the last one brings the first one's rows again."""
    folder, schema = shared_path(spark, "merge"), "iso_code string, line_no long, pos long, link string"
    rows = result_table(spark, sf_dir).select("iso_code", "line_no", "pos", "link")
    third = F.pmod(F.xxhash64("line_no"), F.lit(3))
    for number in range(3):
        wanted = third == number if number < 2 else third != 1
        rows.filter(wanted).write.mode("append").json(f"{folder}/in")
        stream = ingest.read_results(spark, f"{folder}/in", schema)
        merge.merge(stream, rule, f"{folder}/log", f"{folder}/state").awaitTermination()
    return merge.merged(spark, f"{folder}/log", schema, rule)


@query("stream_merge_last", ORACLES["search_merge_last"])
def stream_merge_last(spark, sf_dir):
    return _merged_stream(spark, sf_dir, "last")


@query("stream_merge_append", f"WITH {SQL_RESULTS} SELECT iso_code, line_no, pos, link FROM results")
def stream_merge_append(spark, sf_dir):
    return _merged_stream(spark, sf_dir, "append")


@query(
    "topk_results",
    f"""WITH {SQL_RESULTS} SELECT iso_code, line_no, pos, link FROM (
      SELECT *, row_number() OVER (PARTITION BY iso_code, line_no ORDER BY pos) AS p FROM results) WHERE p <= 3""",
)
def topk_results(spark, sf_dir):
    return seed_sources.top_results(result_table(spark, sf_dir).select("iso_code", "line_no", "pos", "link"), 3)


@query(
    "seed_validate",
    f"""WITH {SQL_SEEDS}, per_host AS (SELECT *, {sql_netloc('link')} AS host FROM seeds)
    SELECT host AS lid_label, link, lid_confidence, predicted_lid FROM per_host p WHERE NOT EXISTS (
      SELECT 1 FROM per_host b WHERE b.host = p.host AND (b.link IS NULL OR b.lid_confidence IS NULL OR b.predicted_lid IS NULL))""",
)
def seed_validate(spark, sf_dir):
    host = F.regexp_extract("link", "^https?://([^/?#]*)", 1)
    entries = seed_table(spark, sf_dir).select(host.alias("lid_label"), "link", "lid_confidence", "predicted_lid")
    return seed_sources.valid_seeds(entries)


# Filters.
@query("blocklist_filter", f"WITH {SQL_LINKS}, {SQL_BLOCKLIST} SELECT ord, link FROM links WHERE {_NOT_BLOCKED.format('link')}")
def blocklist_filter(spark, sf_dir):
    return filters.blocklist_filter(link_table(spark, sf_dir).select("ord", "link"), BLOCKED)


@query("blocklist_antijoin", f"WITH {SQL_LINKS}, {SQL_BLOCKLIST} SELECT ord, link FROM links WHERE {_NOT_BLOCKED.format('link')}")
def blocklist_antijoin(spark, sf_dir):
    entries = spark.createDataFrame([(e,) for e in BLOCKED], "entry string")
    return filters.blocklist_antijoin(link_table(spark, sf_dir).select("ord", "link"), entries)


@query(
    "blocklist_words",
    f"""WITH {SQL_LINKS}, words AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z]{{8,}}')) AS entry FROM documents)
    SELECT ord, link FROM links WHERE {_NOT_BLOCKED.format('link').replace('blocklist', 'words')}""",
)
def blocklist_words(spark, sf_dir):
    """A list as long as the corpus has words of eight letters and more."""
    words = F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{8,}"), F.lit(0)))
    entries = table(spark, sf_dir, "documents").select(words.alias("entry")).distinct()
    return filters.blocklist_filter(link_table(spark, sf_dir).select("ord", "link"), entries)


@query(
    "metadata_blocklist",
    f"""WITH {SQL_LINKS}, {SQL_BLOCKLIST}, metadata AS (
      SELECT lid_label, CASE WHEN link LIKE 'https:%' THEN 'seed_urls' ELSE 'filtered_links' END AS kind, link AS url FROM links)
    SELECT lid_label, kind, url FROM metadata WHERE {_NOT_BLOCKED.format('url')}""",
)
def metadata_blocklist(spark, sf_dir):
    kind = F.when(F.startswith("link", F.lit("https:")), "seed_urls").otherwise("filtered_links")
    metadata = link_table(spark, sf_dir).select("lid_label", kind.alias("kind"), F.col("link").alias("url"))
    return filters.filter_metadata(metadata, BLOCKED)


_EXCLUDED_SQL = ", ".join(f"'{c}'" for c in EXCLUDED)


@query(
    "exclude_high_resource",
    f"""WITH {SQL_SEEDS} SELECT ord, predicted_lid FROM seeds
    WHERE predicted_lid IS NULL OR predicted_lid NOT IN ({_EXCLUDED_SQL})""",
)
def exclude_high_resource(spark, sf_dir):
    codes = spark.createDataFrame([(c,) for c in EXCLUDED], "code string")
    return filters.exclude_labels(seed_table(spark, sf_dir).select("ord", "predicted_lid"), codes)


@query("seed_gate", f"WITH {SQL_SEEDS} SELECT lid_label, ord, link, lid_confidence FROM seeds WHERE lid_confidence > 0.7")
def seed_gate(spark, sf_dir):
    return filters.seed_gate(seed_table(spark, sf_dir)).select("lid_label", "ord", "link", "lid_confidence")


@query(
    "language_gate",
    f"""WITH {SQL_SEEDS} SELECT lid_label, ord, link, lid_confidence FROM seeds
    WHERE predicted_lid = lid_label AND lid_confidence >= 0.7""",
)
def language_gate(spark, sf_dir):
    return filters.language_gate(seed_table(spark, sf_dir), "lid_label").select("lid_label", "ord", "link", "lid_confidence")


@query("filter_by_key", f"WITH {SQL_SEEDS} SELECT lid_label, ord, link FROM seeds WHERE predicted_lid IS NULL")
def filter_by_key(spark, sf_dir):
    return filters.filter_by_key(seed_table(spark, sf_dir), "predicted_lid", None).select("lid_label", "ord", "link")


@query("select_labels", f"WITH {SQL_LINKS} SELECT lid_label, ord, link FROM links WHERE lid_label IN ('fra_Latn', 'spa_Latn')")
def select_labels(spark, sf_dir):
    return filters.select_labels(link_table(spark, sf_dir), ["fra_Latn", "spa_Latn"])


@query(
    "same_site_links",
    f"""WITH {SQL_LINKS}, {SQL_SEEDS},
    hosts AS (SELECT DISTINCT lid_label, {sql_netloc('link')} AS host FROM seeds WHERE lid_confidence > 0.7)
    SELECT lid_label, ord, link FROM links l WHERE length(link) <= 65536 AND EXISTS (
      SELECT 1 FROM hosts h WHERE h.lid_label = l.lid_label AND ends_with({sql_netloc('l.link')}, h.host))""",
)
def same_site_links(spark, sf_dir):
    seeds = filters.seed_gate(seed_table(spark, sf_dir)).select("lid_label", F.col("link").alias("seed_url"))
    return filters.same_site_links(link_table(spark, sf_dir), seeds, ["lid_label"])


# Glossed corpus: documents by source, sources mapped to iso codes through their identifiers.
def _corpus(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.col("doc_id").alias("ord"),
        F.col("source").alias("glottocode"),
        F.when(F.col("doc_id") % 9 != 0, F.col("text")).alias("transcription"),
    )


def _entries(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").groupBy("source").agg(F.min("doc_id").alias("d"))
    iso = F.when(F.col("source").endswith("3"), "").otherwise(F.concat(F.lit("x"), F.substring("source", 4, 1)))
    kind = F.when(F.col("source").endswith("7"), "other").otherwise("iso639-3")
    wals = F.struct(F.col("source").alias("identifier"), F.lit("wals").alias("type"))
    return docs.select(
        F.col("source").alias("id"),
        F.array(wals, F.struct(iso.alias("identifier"), kind.alias("type"))).alias("identifiers"),
    )


SQL_CODED = """mapping AS (
  SELECT DISTINCT source AS glottocode, CASE WHEN source LIKE '%7' THEN NULL WHEN source LIKE '%3' THEN ''
    ELSE 'x' || substr(source, 4, 1) END AS iso_code FROM documents),
corpus AS (SELECT doc_id AS ord, source AS glottocode, CASE WHEN doc_id % 9 <> 0 THEN text END AS transcription FROM documents),
coded AS (SELECT c.*, m.iso_code FROM corpus c LEFT JOIN mapping m USING (glottocode))"""


@query("glotto_iso_map", f"WITH {SQL_CODED} SELECT glottocode, iso_code FROM mapping")
def glotto_iso_map(spark, sf_dir):
    return lookups.glotto_iso_map(_entries(spark, sf_dir))


def _coded(spark, sf_dir):
    return lookups.add_iso(_corpus(spark, sf_dir), lookups.glotto_iso_map(_entries(spark, sf_dir)))


@query("add_iso", f"WITH {SQL_CODED} SELECT ord, glottocode, iso_code FROM coded")
def add_iso(spark, sf_dir):
    return _coded(spark, sf_dir).select("ord", "glottocode", "iso_code")


@query("drop_empty_iso", f"WITH {SQL_CODED} SELECT ord, iso_code FROM coded WHERE nullif(iso_code, '') IS NOT NULL")
def drop_empty_iso(spark, sf_dir):
    return filters.drop_empty(_coded(spark, sf_dir).select("ord", "iso_code"))


@query(
    "median_sample",
    f"""WITH {SQL_CODED}, sized AS (
      SELECT ord, iso_code, coalesce(transcription, 'nan') AS transcription FROM coded WHERE nullif(iso_code, '') IS NOT NULL),
    mid AS (SELECT *, abs(length(transcription) - median(length(transcription)) OVER (PARTITION BY iso_code)) AS diff FROM sized),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY iso_code ORDER BY diff, ord) AS p FROM mid)
    SELECT ord, iso_code, transcription, diff AS diff_from_median FROM ranked WHERE p <= 2""",
)
def median_sample(spark, sf_dir):
    coded = filters.drop_empty(_coded(spark, sf_dir))
    return sampling.median_sample(coded).select("ord", "iso_code", "transcription", "diff_from_median")


@query(
    "prune_nulls",
    """SELECT doc_id, concat_ws(',', CASE WHEN quality = 1 THEN 'quality=1' END, 'source=' || source) AS pruned,
      1 + CASE WHEN quality = 1 THEN 1 ELSE 0 END AS n_values
    FROM documents LEFT JOIN labels USING (doc_id)""",
)
def prune_nulls(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    entry = F.create_map(
        F.lit("quality"), F.when(F.col("quality") == 1, "1"), F.lit("none"), F.lit(None).cast("string"), F.lit("source"), F.col("source")
    )
    items = F.array(F.lit(None).cast("map<string,string>"), entry)
    pruned = rows.select("doc_id", F.get(filters.prune_null_items(items), F.lit(0)).alias("m"))
    shown = F.transform(F.map_entries("m"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return pruned.select("doc_id", F.array_join(shown, ",").alias("pruned"), F.size("m").cast("bigint").alias("n_values"))


@query(
    "extract_codes",
    f"""SELECT doc_id, cell_no, code FROM (
      SELECT doc_id, unnest([{sql_label('lang')}, source, lang || '_' || source, CAST(n_chars AS VARCHAR)]) AS code,
        unnest([0, 1, 2, 3]) AS cell_no FROM documents) WHERE contains(code, '_')""",
)
def extract_codes(spark, sf_dir):
    grid = table(spark, sf_dir, "documents").select(
        "doc_id", label_of(F.col("lang")).alias("a"), F.col("source").alias("b"), F.concat_ws("_", "lang", "source").alias("c"), "n_chars"
    )
    return filters.extract_codes(grid, ["a", "b", "c", "n_chars"], "doc_id")


# Sinks: written by label into the shared folder and read back.
@query("sink_lid_partition", f"WITH {SQL_SEEDS} SELECT predicted_lid, ord, link FROM seeds")
def sink_lid_partition(spark, sf_dir):
    path = shared_path(spark, "by-label")
    rows = seed_table(spark, sf_dir).select("predicted_lid", "ord", "link")
    files.append_by_label(rows, path, fmt="parquet")
    return spark.read.schema("ord bigint, link string, predicted_lid string").parquet(path)



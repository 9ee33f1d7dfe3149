"""Queries that write with a sink or job and read the files back, and forms of operators with other arguments."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkloom.constants import SEED_KEYS_EARLY, SEED_KEYS_LABEL, SITE_CONFIDENCE, SITE_INFO
from linkloom.functions.text import WS, char_tokenize
from linkloom.operators import filters, frontier, lid, lm, lookups, sets, sites
from linkloom.plans import jobs
from linkloom.registry import catalogue, crawling, modelling, screening
from linkloom.registry.base import (
    ORACLES,
    SQL_LINKS,
    SQL_SEEDS,
    SQL_TEXTS,
    label_of,
    link_table,
    page_table,
    query,
    seed_table,
    sql_label,
    sql_name,
    sql_netloc,
    sql_site,
    table,
    text_table,
)
from linkloom.registry.language import SQL_PAGES_PREDICTED, SQL_PROFILE, _predictor, sql_predict
from linkloom.registry.modelling import ORDER, SQL_MODEL
from linkloom.registry.screening import BLOCKED, SQL_BLOCKLIST, SQL_CODED
from linkloom.registry.urls_pages import PAGE_SOURCE, sql_strip_ws
from linkloom.session import shared_path
from linkloom.sinks import files, nested, runs
from linkloom.sources import seeds as seed_sources, tables

_ALLOWED = "NOT EXISTS (SELECT 1 FROM blocklist WHERE contains({}, entry))"


# Entries in one JSON value.
FILE_ENTRIES = 10_000


# Sources.
@query(
    "read_blocklist",
    "SELECT DISTINCT trim(regexp_extract(url, '//([^/?#]*)', 1), ' ') AS entry FROM pages WHERE page_id % 3 <> 0",
)
def read_blocklist(spark, sf_dir):
    host = F.regexp_extract("url", "//([^/?#]*)", 1)
    line = F.when(F.col("page_id") % 3 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), host, F.lit(" ")))
    path = shared_path(spark, "blocklist")
    table(spark, sf_dir, "pages").select(line).write.text(path)
    return tables.read_blocklist(spark, path)


@query("read_label_list", f"SELECT DISTINCT {sql_label('lang')} AS code FROM documents")
def read_label_list(spark, sf_dir):
    labels = table(spark, sf_dir, "documents").agg(F.to_json(F.collect_set(label_of(F.col("lang")))))
    path = shared_path(spark, "labels")
    labels.write.text(path)
    return tables.read_label_list(spark, path)


_CELLS = "SELECT source AS glottocode, text AS transcription, n_chars FROM documents"


@query("read_delimited", _CELLS)
def read_delimited(spark, sf_dir):
    """Written and read with line ends, quotes and commas inside cells."""
    path = shared_path(spark, "glossed")
    rows = table(spark, sf_dir, "documents").select(F.col("source").alias("glottocode"), F.col("text").alias("transcription"), "n_chars")
    files.write_delimited(rows, path)
    return tables.read_delimited(spark, path, "glottocode string, transcription string, n_chars bigint")


@query("read_identifier_map", f"WITH {SQL_CODED} SELECT glottocode, iso_code FROM mapping")
def read_identifier_map(spark, sf_dir):
    path = shared_path(spark, "identifiers")
    entries = screening._entries(spark, sf_dir)
    slices = F.pmod(F.xxhash64("id"), F.lit(entries.count() // FILE_ENTRIES + 1))
    body = F.to_json(F.struct(F.collect_list(F.struct("id", "identifiers")).alias("resources")))
    # The reader takes a file for one value.
    entries.groupBy(slices.alias("slice")).agg(body.alias("value")).select("value").write.option("maxRecordsPerFile", 1).text(path)
    return lookups.glotto_iso_map(tables.read_identifier_map(spark, path))


@query(
    "read_seed_queries",
    f"""SELECT item_id AS line_no, {sql_label("['en', 'fr', 'de', 'es'][item_id % 4 + 1]")} AS iso_code, text AS query
    FROM (SELECT item_id, regexp_replace(text, '[\\t\\n]', ' ', 'g') AS text FROM benchmark) WHERE item_id >= 5 AND item_id % 7 <> 0""",
)
def read_seed_queries(spark, sf_dir):
    """Files of lines in order, one after the other; some lines are not two fields."""
    path = shared_path(spark, "queries")
    lines = screening._query_lines(spark, sf_dir)
    broken = F.when(F.col("line_no") % 7 == 0, F.lit("no tab here")).otherwise(F.regexp_replace("value", "\n$", ""))
    lines.withColumn("value", broken).repartitionByRange(4, "line_no").sortWithinPartitions("line_no").select("value").write.text(path)
    return seed_sources.read_seed_queries(spark, path, 5)


@query("read_ordered", "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS ord, doc_id, source FROM documents")
def read_ordered(spark, sf_dir):
    """Delimited files written in ranges of ids and read as one."""
    path = shared_path(spark, "ordered")
    docs = table(spark, sf_dir, "documents").select("source", "doc_id").repartitionByRange(5, "doc_id").sortWithinPartitions("doc_id")
    files.write_delimited(docs, path, "\t")
    return tables.read_ordered(spark, path, ["doc_id", "source"], "\t").select("ord", F.col("doc_id").cast("bigint").alias("doc_id"), "source")


@query("rejected_query_lines", "SELECT item_id AS line_no, 'no tab here' AS value FROM benchmark WHERE item_id % 7 = 0 AND item_id >= 5")
def rejected_query_lines(spark, sf_dir):
    lines = screening._query_lines(spark, sf_dir)
    broken = F.when(F.col("line_no") % 7 == 0, F.lit("no tab here")).otherwise(F.col("value"))
    return seed_sources.rejected_query_lines(lines.withColumn("value", broken), 5)


# Seed files, one label for each host.
def _seed_entries(spark, sf_dir):
    host = F.regexp_extract("link", "^https?://([^/?#]*)", 1)
    return seed_table(spark, sf_dir).select(
        host.alias("lid_label"),
        "link",
        "lid_confidence",
        "predicted_lid",
        F.when(F.col("ord") % 5 != 0, F.concat(F.lit("s"), F.col("ord").cast("string"))).alias("snippet"),
        F.lit("t").alias("title"),
        F.array(F.lit("e")).alias("engines"),
        F.lit("c").alias("category"),
    )


_PER_HOST = f"{SQL_SEEDS}, per_host AS (SELECT *, {sql_netloc('link')} AS host, CASE WHEN ord % 5 <> 0 THEN 's' || ord END AS snippet FROM seeds)"


@query(
    "seed_files",
    f"""WITH {_PER_HOST} SELECT host AS lid_label, link, lid_confidence, predicted_lid FROM per_host p WHERE NOT EXISTS (
      SELECT 1 FROM per_host b WHERE b.host = p.host AND (b.link IS NULL OR b.lid_confidence IS NULL OR b.predicted_lid IS NULL))""",
)
def seed_files(spark, sf_dir):
    """JSON arrays of about ``FILE_ENTRIES`` entries of a label, one in each file of its folder."""
    path = shared_path(spark, "seed-files")
    entries = _seed_entries(spark, sf_dir)
    body = F.to_json(F.collect_list(F.struct(*[c for c in entries.columns if c != "lid_label"])))
    sizes = entries.groupBy(F.col("lid_label").alias("of")).agg(F.count("*").alias("n"))
    sliced = entries.join(sizes, F.col("lid_label").eqNullSafe(F.col("of"))).withColumn(
        "slice", F.expr(f"pmod(xxhash64(link), n div {FILE_ENTRIES} + 1)")
    )
    arrays = sliced.groupBy("lid_label", "slice").agg(body.alias("value")).drop("slice")
    # The reader takes a file for one value.
    arrays.write.partitionBy("lid_label").option("maxRecordsPerFile", 1).text(path)
    return seed_sources.read_seed_files(spark, path).select("lid_label", "link", "lid_confidence", "predicted_lid")


@query(
    "seed_validate_early",
    f"""WITH {_PER_HOST} SELECT host AS lid_label, link, snippet FROM per_host p WHERE NOT EXISTS (SELECT 1 FROM per_host b WHERE b.host = p.host
      AND (b.link IS NULL OR b.lid_confidence IS NULL OR b.predicted_lid IS NULL OR b.snippet IS NULL))""",
)
def seed_validate_early(spark, sf_dir):
    return seed_sources.valid_seeds(_seed_entries(spark, sf_dir), SEED_KEYS_EARLY).select("lid_label", "link", "snippet")


@query(
    "seed_validate_label",
    f"""WITH {_PER_HOST} SELECT host, link, lid_label FROM per_host p WHERE NOT EXISTS (
      SELECT 1 FROM per_host b WHERE b.host = p.host AND (b.link IS NULL OR b.lid_confidence IS NULL OR b.lid_label IS NULL))""",
)
def seed_validate_label(spark, sf_dir):
    host = F.regexp_extract("link", "^https?://([^/?#]*)", 1)
    entries = seed_table(spark, sf_dir).select("lid_label", "link", "lid_confidence", host.alias("host"))
    return seed_sources.valid_seeds(entries, SEED_KEYS_LABEL, "host").select("host", "link", "lid_label")


# Sinks.
@query(
    "sink_overwrite",
    f"""WITH {SQL_LINKS} SELECT lid_label, ord, link FROM links WHERE lid_label <> 'fra_Latn'
      UNION ALL SELECT lid_label, -ord, link FROM links WHERE lid_label = 'fra_Latn'""",
)
def sink_overwrite(spark, sf_dir):
    """Only the labels of the second write are replaced."""
    path = shared_path(spark, "overwritten")
    rows = link_table(spark, sf_dir)
    files.overwrite_by_label(rows, path)
    files.overwrite_by_label(rows.filter("lid_label = 'fra_Latn'").withColumn("ord", -F.col("ord")), path)
    return spark.read.schema("ord bigint, link string, lid_label string").json(path)


@query(
    "sink_metadata",
    f"""WITH {SQL_LINKS}, {crawling.SQL_LISTS} SELECT lid_label, 'seed_urls' AS kind, url FROM s
      UNION ALL SELECT DISTINCT lid_label, 'all_website_links', link FROM links UNION ALL SELECT lid_label, 'filtered_links', url FROM f
      UNION ALL SELECT lid_label, 'unique_links', url FROM (SELECT * FROM f EXCEPT SELECT * FROM s)
      UNION ALL SELECT lid_label, 'rejected_links', url FROM (SELECT * FROM s EXCEPT SELECT * FROM f)""",
)
def sink_metadata(spark, sf_dir):
    path = shared_path(spark, "metadata")
    files.write_metadata(_metadata(spark, sf_dir), path)
    return tables.read_metadata(spark, path)


def _metadata(spark, sf_dir):
    seeds, filtered = crawling._lists(spark, sf_dir)
    return sets.crawl_metadata(seeds, link_table(spark, sf_dir).select("lid_label", F.col("link").alias("url")), filtered)


@query("sink_text", f"WITH {SQL_TEXTS} SELECT lid_label, unnest(string_split(text, chr(10))) AS text FROM texts")
def sink_text(spark, sf_dir):
    path = shared_path(spark, "texts")
    files.write_text_by_label(text_table(spark, sf_dir), path)
    return tables.read_label_files(spark, path).select("lid_label", "text")


@query("read_pages", "SELECT url, html FROM pages")
def read_pages(spark, sf_dir):
    return tables.read_pages(spark, f"{sf_dir}/pages.parquet")


@query("read_texts", f"WITH {SQL_TEXTS} SELECT lid_label, doc_id, text FROM texts")
def read_texts(spark, sf_dir):
    path = shared_path(spark, "corpus")
    text_table(spark, sf_dir).write.parquet(path)
    return tables.read_texts(spark, path)


@query("tokenize_corpus", f"SELECT doc_id, tokens AS text FROM ({ORACLES['char_tokenize']})")
def tokenize_corpus(spark, sf_dir):
    corpus = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm.tokenize_corpus(corpus, char_tokenize)


@query(
    "sink_report",
    f"WITH {SQL_LINKS} SELECT lid_label, site_url, CAST(count(*) AS VARCHAR) AS n_links FROM (SELECT lid_label, {sql_site('link')} AS site_url FROM links) GROUP BY ALL",
)
def sink_report(spark, sf_dir):
    path = shared_path(spark, "report")
    files.write_report(sites.domain_distribution(sites.group_by_site(link_table(spark, sf_dir))), path, one_file=False)
    return spark.read.option("header", True).csv(path)


@query(
    "sink_append_runs",
    f"WITH {SQL_SEEDS} SELECT predicted_lid, ord, link, CASE WHEN ord % 3 = 0 THEN 'first' ELSE 'rest' END AS run FROM seeds",
)
def sink_append_runs(spark, sf_dir):
    """Two runs append, one of them twice, beside an attempt that was never committed; then the store is compacted."""
    path = shared_path(spark, "runs")
    seeds = seed_table(spark, sf_dir).select("predicted_lid", "ord", "link", F.when(F.col("ord") % 3 == 0, "first").otherwise("rest").alias("run"))
    files.overwrite_by_label(seeds, f"{path}/data/died-midway", "predicted_lid")
    for run in ("first", "rest", "first"):
        runs.append_run(seeds.filter(F.col("run") == run), path, run)
    schema = "ord bigint, link string, run string, predicted_lid string"
    runs.compact(spark, path, schema)
    runs.append_run(seeds.filter("run = 'rest'"), path, "rest")
    return runs.read_runs(spark, path, schema)


# Filters with other arguments.
@query(
    "blocklist_nulls",
    f"WITH {SQL_LINKS}, {SQL_BLOCKLIST} SELECT ord, link FROM links WHERE ord % 7 <> 0 AND {_ALLOWED.format('link')}",
)
def blocklist_nulls(spark, sf_dir):
    """Entries without a link are dropped, with a list too long for literals too."""
    rows = link_table(spark, sf_dir).select("ord", F.when(F.col("ord") % 7 != 0, F.col("link")).alias("link"))
    return filters.blocklist_filter(rows, [*BLOCKED, *screening.UNUSED])


@query("exclude_with_null", f"WITH {SQL_SEEDS} SELECT ord, predicted_lid FROM seeds WHERE predicted_lid IS NULL OR predicted_lid <> 'eng_Latn'")
def exclude_with_null(spark, sf_dir):
    return filters.exclude_labels(seed_table(spark, sf_dir).select("ord", "predicted_lid"), ["eng_Latn", None])


@query(
    "same_site_every_seed",
    f"""WITH {SQL_SEEDS}, s AS (SELECT ord AS seed_id, {sql_netloc('link')} AS host FROM seeds WHERE lid_confidence > 0.7),
    t AS (SELECT page_id, url, {sql_netloc('url')} AS host FROM pages)
    SELECT seed_id, page_id, url AS link FROM t JOIN s ON ends_with(t.host, s.host)""",
)
def same_site_every_seed(spark, sf_dir):
    seeds = filters.seed_gate(seed_table(spark, sf_dir)).select(F.col("ord").alias("seed_id"), F.col("link").alias("seed_url"))
    return _same_site(spark, sf_dir, seeds)


def _same_site(spark, sf_dir, seeds):
    links = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("link"))
    return filters.same_site_pairs(links, seeds, ["seed_id"])


@query(
    "filtered_texts",
    f"""WITH {SQL_LINKS}, {SQL_PAGES_PREDICTED} SELECT l.lid_label, ord, l.link, t.text FROM links l JOIN predicted p ON p.link = l.link
    JOIN page_texts t ON t.link = l.link WHERE p.predicted_lid = l.lid_label AND p.lid_confidence >= 0.7""",
)
def filtered_texts(spark, sf_dir):
    """Texts are kept on request."""
    kept = lid.filter_links(link_table(spark, sf_dir), page_table(spark, sf_dir), _predictor(spark, sf_dir), 0.7, save_text=True, source=PAGE_SOURCE)
    return kept.select("lid_label", "ord", "link", "text")


@query("concatenate", f"WITH {SQL_LINKS}, {crawling.SQL_LISTS} SELECT lid_label, url FROM s UNION ALL SELECT lid_label, url FROM f")
def concatenate(spark, sf_dir):
    return sets.concatenate(*crawling._lists(spark, sf_dir))


# Each document crawled alone.
_STARTS = crawling.SQL_CRAWL[crawling.SQL_CRAWL.index("  starts AS ") : crawling.SQL_CRAWL.index("  bfs(")]
_PER_SEED = (
    crawling.SQL_CRAWL.replace(_STARTS, f"  starts AS (SELECT DISTINCT doc_id AS lid_label, {crawling._URL.format('d')} AS url FROM documents d),\n")
    .replace(" AND e.lid_label = b.lid_label", "")
    .replace(f"<= {crawling.BUDGET}", "<= 12")
)


@query("crawl_per_seed", f"WITH RECURSIVE {_PER_SEED} SELECT lid_label AS seed_id, url, depth, rank FROM bfs")
def crawl_per_seed(spark, sf_dir):
    _, edges = crawling._graph(spark, sf_dir)
    docs = table(spark, sf_dir, "documents")
    url = F.concat(F.lit("http://"), "lang", F.lit(".example.org/"), F.col("doc_id").cast("string"))
    seeds = docs.select(F.col("doc_id").alias("seed_id"), url.alias("url"))
    done = frontier.crawl(seeds, edges, ["seed_id"], max_pages=12, growth_factor=None, seeds_are_links=False)
    return done.visits.select("seed_id", "url", "depth", "rank")


# Jobs.
@query(
    "final_filter_job",
    f"""WITH {SQL_LINKS}, {SQL_BLOCKLIST}, {crawling.SQL_LISTS}, longform AS (
      SELECT lid_label, 'seed_urls' AS kind, url FROM s UNION ALL SELECT DISTINCT lid_label, 'all_website_links', link FROM links
      UNION ALL SELECT lid_label, 'filtered_links', url FROM f
      UNION ALL SELECT lid_label, 'unique_links', url FROM (SELECT * FROM f EXCEPT SELECT * FROM s)
      UNION ALL SELECT lid_label, 'rejected_links', url FROM (SELECT * FROM s EXCEPT SELECT * FROM f)),
    allowed AS (SELECT * FROM longform WHERE {_ALLOWED.format('url')})
    SELECT 'crawled' AS part, lid_label, NULL AS kind, link AS url FROM links WHERE {_ALLOWED.format('link')}
    UNION ALL SELECT 'lists', lid_label, kind, url FROM allowed
    UNION ALL SELECT 'lists', lid_label, 'active_seed_urls', url FROM (
      SELECT lid_label, url FROM allowed WHERE kind = 'seed_urls' EXCEPT SELECT lid_label, url FROM allowed WHERE kind = 'rejected_links')""",
)
def final_filter_job(spark, sf_dir):
    """Both outputs, written and read back; the blocklist as a table."""
    path = shared_path(spark, "final")
    entries = spark.createDataFrame([(e,) for e in [*BLOCKED, *screening.UNUSED]], "entry string")
    jobs.final_filter(link_table(spark, sf_dir).select("lid_label", "link"), _metadata(spark, sf_dir), entries, path)
    crawled = spark.read.schema("link string, lid_label string").json(f"{path}/crawled")
    lists = tables.read_metadata(spark, f"{path}/meta_data")
    return crawled.select(F.lit("crawled").alias("part"), "lid_label", F.lit(None).cast("string").alias("kind"), F.col("link").alias("url")).unionByName(
        lists.select(F.lit("lists").alias("part"), "lid_label", "kind", "url")
    )


@query("catalogue_files", ORACLES["clean_catalogue"])
def catalogue_files(spark, sf_dir):
    """The cleaned catalogue from its files."""
    path = shared_path(spark, "catalogue")
    jobs.clean_catalogue(catalogue._catalogue(spark, sf_dir), catalogue._robots(spark, sf_dir), path=path)
    links = spark.read.schema("site_name string, site_url string, ord bigint, link string, lid_label string").json(f"{path}/site_links")
    languages = spark.read.schema("language_name string, family string, lid_label string").json(f"{path}/languages")
    return catalogue.per_site(links, languages)


_SITED = f"""{SQL_LINKS}, sited AS (SELECT lid_label, ord, link, {sql_site('link')} AS site_url, {sql_name(sql_netloc('link'))} AS site_name FROM links),
  places AS (SELECT *, min(ord) OVER (PARTITION BY lid_label, site_name, site_url) AS first FROM sited)"""


@query(
    "catalogue_nested",
    f"""WITH {_SITED} SELECT lid_label, dense_rank() OVER (PARTITION BY lid_label ORDER BY first, site_url, site_name) AS site_no, site_name, site_url,
      '{SITE_INFO}' AS info, '{SITE_CONFIDENCE}' AS confidence, row_number() OVER (PARTITION BY lid_label, site_name, site_url ORDER BY ord, link) AS link_no, link
    FROM places""",
)
def catalogue_nested(spark, sf_dir):
    """The nested documents of all labels, written and read back as links."""
    path = shared_path(spark, "nested")
    catalogue._catalogue(spark, sf_dir).write_nested(path)
    return nested.read_nested(spark, path)[1]


@query(
    "catalogue_sites",
    f"""WITH {_SITED} SELECT lid_label, site_name, site_url, min(ord) AS first_ord, count(*) AS n_links, '{SITE_INFO}' AS info, '{SITE_CONFIDENCE}' AS confidence
    FROM sited GROUP BY ALL""",
)
def catalogue_sites(spark, sf_dir):
    return catalogue._catalogue(spark, sf_dir).sites()


@query(
    "sample_seeds_job",
    f"SELECT iso_code, transcription FROM ({ORACLES['median_sample']})",
)
def sample_seeds_job(spark, sf_dir):
    return jobs.sample_seeds(screening._corpus(spark, sf_dir), screening._entries(spark, sf_dir))


# Models of corpora cut to equal length, read back from their files.
_CUT = f"""texts0 AS (SELECT {sql_label('lang')} AS lid_label, doc_id, text FROM documents),
  least AS (SELECT min(n) AS n FROM (SELECT sum(length(text)) AS n FROM texts0 GROUP BY lid_label)),
  run AS (SELECT *, sum(length(text)) OVER (PARTITION BY lid_label ORDER BY doc_id) - length(text) AS before FROM texts0),
  texts AS (SELECT lid_label, doc_id, substr(text, 1, CAST(n - before AS BIGINT)) AS text FROM run CROSS JOIN least WHERE n > before)"""


@query(
    "language_model_files",
    f"WITH {SQL_MODEL.replace(SQL_TEXTS, _CUT)} SELECT lid_label, ngram, CAST(CAST(round(log10_prob, 7) AS DECIMAL(12, 7)) AS VARCHAR) AS log10_prob FROM model WHERE log10_prob IS NOT NULL",
)
def language_model_files(spark, sf_dir):
    path = shared_path(spark, "arpa")
    jobs.build_language_models(text_table(spark, sf_dir), order=ORDER, path=path, tokenizer=char_tokenize)
    lines = spark.read.schema("line string, lid_label string").text(path)
    cells = F.split("line", "\t")
    grams = lines.filter(F.size(cells) >= 2).select("lid_label", F.get(cells, F.lit(1)).alias("ngram"), F.get(cells, F.lit(0)).alias("log10_prob"))
    return grams.filter("log10_prob <> '-99'")


SQL_LABEL_COUNTS = modelling.SQL_COUNTS.replace(SQL_TEXTS, f"""texts1 AS (SELECT {sql_label('lang')} AS lid_label, doc_id, text FROM documents),
  texts AS (SELECT lid_label, min(doc_id) AS doc_id, string_agg(text, '' ORDER BY doc_id) AS text FROM texts1 GROUP BY lid_label)""")


@query("ngram_counts_by_label", f"WITH {SQL_LABEL_COUNTS} SELECT lid_label, n, ngram, cnt FROM counts")
def ngram_counts_by_label(spark, sf_dir):
    """All of a label as one sentence."""
    counts = lm.ngram_counts(text_table(spark, sf_dir), ORDER, sentence_is="label")
    return counts.select("lid_label", "n", lm.shown("gram").alias("ngram"), "cnt")


@query(
    "raw_labels",
    f"SELECT doc_id, CASE WHEN n_chars % 2 = 0 THEN {sql_label('lang')} END AS predicted_lid, 0.5 AS lid_confidence FROM documents WHERE length(text) > 0",
)
def raw_labels(spark, sf_dir):
    """A model that answers ``__label__xxx_Script``, and something else for odd texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", "text")
    answer = F.when(F.col("n_chars") % 2 == 0, F.concat(F.lit("__label__"), label_of(F.col("lang")))).otherwise(F.lit("no label"))
    tagged = lid.tag_language(docs, lambda _: F.struct(answer.alias("label"), F.lit(0.5).alias("confidence")), raw_labels=True, drop_empty=True)
    return tagged.select("doc_id", "predicted_lid", "lid_confidence")


# Seeds over pages that are made of the documents: a graph many levels deep, with a budget and a guard that bite.
def _deep_pages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    _, edges = crawling._graph(spark, sf_dir)
    anchors = F.array_join(F.sort_array(F.collect_list(F.concat(F.lit('<a href="'), F.col("dst"), F.lit('">x</a>')))), "")
    url = F.concat(F.lit("http://"), "lang", F.lit(".example.org/"), F.col("doc_id").cast("string"))
    text = F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    pages = docs.select(url.alias("url"), text.alias("text"))
    linked = pages.join(edges.groupBy(F.col("src").alias("url")).agg(anchors.alias("links")), "url", "left")
    html = F.concat(F.lit("<html><body>"), F.coalesce("links", F.lit("")), F.lit("<article>"), "text", F.lit("</article></body></html>"))
    return linked.select("url", html.alias("html"))


_BLANKS = f"regexp_replace(d.text, '{WS}+', ' ', 'g')"
_DEEP = f"""{crawling.SQL_CRAWL}, {crawling.SQL_GUARD},
  visited AS (SELECT b.* FROM bfs b LEFT JOIN tripped t ON t.lid_label = b.lid_label WHERE stop IS NULL OR rank <= stop),
  found AS (SELECT lid_label, url FROM starts UNION SELECT b.lid_label, e.dst FROM visited b JOIN edges e ON e.src = b.url AND e.lid_label = b.lid_label),
  {SQL_PROFILE}, sources AS (SELECT {crawling._URL.format('d')} AS link, replace({sql_strip_ws(_BLANKS)}, chr(10), '') AS t FROM documents d
    WHERE length({sql_strip_ws(_BLANKS)}) > 0), {sql_predict('sources', 'link')},
  filtered AS (SELECT f.lid_label, f.url FROM found f JOIN predicted p ON p.link = f.url WHERE p.predicted_lid = f.lid_label AND p.lid_confidence >= 0.7)"""


@query(
    "deep_expansion_job",
    f"""WITH RECURSIVE {_DEEP}
    SELECT lid_label, 'seed_urls' AS kind, url FROM starts
    UNION ALL SELECT lid_label, 'all_website_links', url FROM found
    UNION ALL SELECT lid_label, 'filtered_links', url FROM filtered
    UNION ALL SELECT lid_label, 'unique_links', url FROM (SELECT * FROM filtered EXCEPT SELECT * FROM starts)
    UNION ALL SELECT lid_label, 'rejected_links', url FROM (SELECT * FROM starts EXCEPT SELECT * FROM filtered)""",
)
def deep_expansion_job(spark, sf_dir):
    seeds, _ = crawling._graph(spark, sf_dir)
    entries = seeds.select("lid_label", F.col("url").alias("link"), F.col("lid_label").alias("predicted_lid"), F.lit(0.9).alias("lid_confidence"))
    done = jobs.expand_seeds(
        entries, _deep_pages(spark, sf_dir), _predictor(spark, sf_dir), blocklist=[], max_pages=crawling.BUDGET, growth_factor=crawling.FACTOR
    )
    return done.metadata

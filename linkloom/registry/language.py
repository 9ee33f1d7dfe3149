"""Queries on language identification and the jobs built on it."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkloom.functions.text import drop_newlines
from linkloom.operators import filters, learnt, lid, pages as page_ops, sets
from linkloom.plans import jobs
from linkloom.registry.base import SQL_LINKS, SQL_SEEDS, SQL_TEXTS, link_table, query, seed_table, sql_netloc, page_table, table, text_table
from linkloom.registry.screening import BLOCKED, EXCLUDED, SQL_BLOCKLIST, UNUSED
from linkloom.registry.urls_pages import PAGE_SOURCE, SQL_ALL_TEXT, SQL_EDGES, SQL_HREFS, SQL_PAGE_TEXTS
from linkloom.session import shared_path, stored
from linkloom.streaming import ingest

_NO_BREAKS = "replace({}, chr(10), '')"


def sql_grams(source: str, key: str, n: int = 3) -> str:
    """Rows (key, gram) for each run of ``n`` characters of ``t`` in ``source``."""
    gram = " || ".join(f"l[i + {k}]" for k in range(n))
    return f"""SELECT {key}, {gram} AS gram FROM (
      SELECT {key}, l, unnest(range(1, len(l) - {n - 2})) AS i FROM (SELECT {key}, string_split(t, '') AS l FROM {source} WHERE length(t) >= {n}))"""


def sql_profile(n: int = 3) -> str:
    return f"""{SQL_TEXTS}, flat AS (SELECT lid_label, {_NO_BREAKS.format('text')} AS t FROM texts),
counts AS (SELECT lid_label, gram, count(*) AS cnt FROM ({sql_grams('flat', 'lid_label', n)}) GROUP BY ALL),
mass AS (SELECT lid_label, sum(cnt) + (SELECT count(DISTINCT gram) FROM counts) AS mass FROM counts GROUP BY lid_label),
profile AS (SELECT lid_label, gram, cnt, ln((cnt + 1) / mass) AS log_prob, ln(1 / mass) AS unseen FROM counts JOIN mass USING (lid_label))"""


SQL_PROFILE = sql_profile()


def sql_predict(source: str, key: str, n: int = 3) -> str:
    """CTEs that end in ``predicted`` (key, predicted_lid, lid_confidence) for ``source`` (key, t)."""
    return f"""grams AS (SELECT {key}, gram, count(*) AS c FROM ({sql_grams(source, key, n)}) GROUP BY ALL),
  bases AS (SELECT DISTINCT lid_label, unseen FROM profile),
  matched AS (SELECT {key}, lid_label, sum(c * (log_prob - unseen)) AS gain FROM grams JOIN profile USING (gram) GROUP BY ALL),
  scores AS (SELECT s.{key}, b.lid_label, coalesce(gain, 0) + greatest(length(t) - {n - 1}, 0) * unseen AS score
    FROM {source} s CROSS JOIN bases b LEFT JOIN matched m ON m.{key} = s.{key} AND m.lid_label = b.lid_label),
  best AS (SELECT {key}, max(score) AS top FROM scores GROUP BY {key}),
  predicted AS (SELECT {key}, first(lid_label ORDER BY score DESC, lid_label) AS predicted_lid, 1 / sum(exp(score - top)) AS lid_confidence
    FROM scores JOIN best USING ({key}) GROUP BY {key})"""


@query("lid_train_profile", f"WITH {SQL_PROFILE} SELECT lid_label, gram, cnt, round(log_prob, 6) AS log_prob, round(unseen, 6) AS unseen FROM profile")
def lid_train_profile(spark, sf_dir):
    profile = lid.train_profile(text_table(spark, sf_dir))
    return profile.withColumn("log_prob", F.round("log_prob", 6)).withColumn("unseen", F.round("unseen", 6))


def _predictor(spark, sf_dir):
    return lid.fit_predictor(text_table(spark, sf_dir))


def _rounded(df):
    return df.withColumn("lid_confidence", F.round("lid_confidence", 6))


SQL_PAGES_PREDICTED = f"""{SQL_PROFILE}, {SQL_PAGE_TEXTS},
  sources AS (SELECT link, {_NO_BREAKS.format('text')} AS t FROM page_texts WHERE text IS NOT NULL), {sql_predict('sources', 'link')}"""


@query("lid_predict", f"WITH {SQL_PAGES_PREDICTED} SELECT link, predicted_lid, round(lid_confidence, 6) AS lid_confidence FROM predicted")
def lid_predict(spark, sf_dir):
    texts = page_ops.page_texts(page_table(spark, sf_dir), source=PAGE_SOURCE)
    return _rounded(lid.tag_pages(texts, _predictor(spark, sf_dir))[0])


@query("lid_predict_join", f"WITH {SQL_PAGES_PREDICTED} SELECT link, predicted_lid, round(lid_confidence, 6) AS lid_confidence FROM predicted")
def lid_predict_join(spark, sf_dir):
    texts = page_ops.page_texts(page_table(spark, sf_dir), source=PAGE_SOURCE)
    read = texts.select("link", lid.readable("text").alias("text"))
    return _rounded(lid.predict_by_join(read, lid.fit_profile(text_table(spark, sf_dir)), "link"))


@query("lid_learnt")
def lid_learnt(spark, sf_dir):
    """Weights learnt from all documents, applied to all pages; no twin, as SQL cannot fit them."""
    model = learnt.fit_learnt(text_table(spark, sf_dir))
    texts = page_ops.page_texts(page_table(spark, sf_dir), source=PAGE_SOURCE)
    return lid.tag_language(texts, model).select("link", "predicted_lid", "lid_confidence")


def sql_predicted(n: int) -> str:
    return f"""WITH {sql_profile(n)}, {SQL_PAGE_TEXTS},
  sources AS (SELECT link, {_NO_BREAKS.format('text')} AS t FROM page_texts WHERE text IS NOT NULL), {sql_predict('sources', 'link', n)}
  SELECT link, predicted_lid, round(lid_confidence, 6) AS lid_confidence FROM predicted"""


@query("lid_predict_2", sql_predicted(2))
def lid_predict_2(spark, sf_dir):
    texts = page_ops.page_texts(page_table(spark, sf_dir), source=PAGE_SOURCE)
    predictor = lid.profile_predictor(lid.fit_profile(text_table(spark, sf_dir), n=2))
    return _rounded(lid.tag_pages(texts, predictor)[0])


@query("lid_predict_4", sql_predicted(4))
def lid_predict_4(spark, sf_dir):
    texts = page_ops.page_texts(page_table(spark, sf_dir), source=PAGE_SOURCE)
    predictor = lid.profile_predictor(lid.fit_profile(text_table(spark, sf_dir), n=4))
    return _rounded(lid.tag_pages(texts, predictor)[0])


@query("lid_predict_join_2", sql_predicted(2))
def lid_predict_join_2(spark, sf_dir):
    texts = page_ops.page_texts(page_table(spark, sf_dir), source=PAGE_SOURCE)
    return _rounded(lid.tag_pages(texts, lid.fit_profile(text_table(spark, sf_dir), n=2))[0])


@query("lid_predict_join_4", sql_predicted(4))
def lid_predict_join_4(spark, sf_dir):
    texts = page_ops.page_texts(page_table(spark, sf_dir), source=PAGE_SOURCE)
    return _rounded(lid.tag_pages(texts, lid.fit_profile(text_table(spark, sf_dir), n=4))[0])


@query("lid_tally", f"WITH {SQL_PAGES_PREDICTED} SELECT predicted_lid, count(*) AS n FROM predicted GROUP BY 1")
def lid_tally(spark, sf_dir):
    texts = page_ops.page_texts(page_table(spark, sf_dir), source=PAGE_SOURCE)
    return lid.lid_tally(lid.tag_pages(texts, _predictor(spark, sf_dir))[0])


_NOT_EXCLUDED = "predicted_lid NOT IN ({})".format(", ".join(f"'{c}'" for c in EXCLUDED))
_ALLOWED = "NOT EXISTS (SELECT 1 FROM blocklist WHERE contains({}, entry))"


@query(
    "language_filter_job",
    f"""WITH {SQL_LINKS}, {SQL_BLOCKLIST}, {SQL_PAGES_PREDICTED}
    SELECT l.lid_label, ord, l.link, predicted_lid, round(lid_confidence, 6) AS lid_confidence FROM links l
    JOIN predicted p ON p.link = l.link WHERE {_ALLOWED.format('l.link')} AND {_NOT_EXCLUDED}""",
)
def language_filter_job(spark, sf_dir):
    kept = jobs.search_language_filter(
        link_table(spark, sf_dir), page_table(spark, sf_dir), _predictor(spark, sf_dir), EXCLUDED, BLOCKED, source=PAGE_SOURCE
    )
    return _rounded(kept.select("lid_label", "ord", "link", "predicted_lid", "lid_confidence"))


# Filed by the query's language and read back.
@query(
    "lang_filter_by_query",
    f"""WITH {SQL_LINKS}, {SQL_BLOCKLIST}, {SQL_PAGES_PREDICTED}
    SELECT l.lid_label AS iso_code, ord, l.link, predicted_lid FROM links l
    JOIN predicted p ON p.link = l.link WHERE {_ALLOWED.format('l.link')} AND {_NOT_EXCLUDED}""",
)
def lang_filter_by_query(spark, sf_dir):
    results = link_table(spark, sf_dir).withColumnRenamed("lid_label", "iso_code")
    path = shared_path(spark, "by-query")
    jobs.search_language_filter(results, page_table(spark, sf_dir), _predictor(spark, sf_dir), EXCLUDED, BLOCKED, path, "iso_code", source=PAGE_SOURCE)
    return spark.read.schema("ord bigint, link string, predicted_lid string, iso_code string").json(path)


_ALL_TEXT = f"""{SQL_PROFILE}, sources AS (SELECT url AS link, {_NO_BREAKS.format(SQL_ALL_TEXT)} AS t FROM pages), {sql_predict('sources', 'link')}"""


@query(
    "lang_filter_all_text",
    f"""WITH {SQL_LINKS}, {SQL_BLOCKLIST}, {_ALL_TEXT} SELECT l.lid_label, ord, l.link, predicted_lid FROM links l
    JOIN predicted p ON p.link = l.link WHERE {_ALLOWED.format('l.link')} AND {_NOT_EXCLUDED}""",
)
def lang_filter_all_text(spark, sf_dir):
    """All visible text instead of the main text; a blocklist beyond literals, as a table."""
    entries = spark.createDataFrame([(e,) for e in [*BLOCKED, *UNUSED]], "entry string")
    kept = jobs.search_language_filter(
        link_table(spark, sf_dir), page_table(spark, sf_dir), _predictor(spark, sf_dir), EXCLUDED, entries, source="stripped_closed", drop_empty=True
    )
    return kept.select("lid_label", "ord", "link", "predicted_lid")


SQL_TURNS_PREDICTED = f"""{SQL_PROFILE}, turns AS (SELECT conv_id * 1000 + turn AS k, text FROM conversations),
  sources AS (SELECT k, {{}} AS t FROM turns), {sql_predict('sources', 'k')}"""


def _turns(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return turns.select((F.col("conv_id") * 1000 + F.col("turn")).alias("k"), F.col("text").alias("snippet"))


_SNIPPETS = f"WITH {SQL_TURNS_PREDICTED.format('text')} SELECT k, text AS snippet FROM turns JOIN predicted USING (k) WHERE {_NOT_EXCLUDED}"


@query("snippet_lang_filter", _SNIPPETS)
def snippet_lang_filter(spark, sf_dir):
    return lid.snippet_language_filter(_turns(spark, sf_dir), _predictor(spark, sf_dir), EXCLUDED)


@query("snippet_lang_filter_join", _SNIPPETS)
def snippet_lang_filter_join(spark, sf_dir):
    return lid.snippet_language_filter(_turns(spark, sf_dir), lid.fit_profile(text_table(spark, sf_dir)), EXCLUDED)


SQL_FILTERED = f"""starts AS (SELECT DISTINCT lid_label, link AS url FROM seeds WHERE predicted_lid IS NOT NULL AND lid_confidence > 0.7),
  found AS (SELECT lid_label, url FROM starts UNION SELECT s.lid_label, dst FROM starts s JOIN edges e ON e.src = s.url
    WHERE EXISTS (SELECT 1 FROM starts h WHERE h.lid_label = s.lid_label AND ends_with({sql_netloc('dst')}, {sql_netloc('h.url')}))),
  filtered AS (SELECT f.lid_label, f.url FROM found f JOIN predicted p ON p.link = f.url
    WHERE p.predicted_lid = f.lid_label AND p.lid_confidence >= 0.7)"""


def _expansion(spark, sf_dir):
    seeds = filters.seed_gate(seed_table(spark, sf_dir)).filter(F.col("predicted_lid").isNotNull())
    pages = page_table(spark, sf_dir)
    return jobs.expand_seeds(seeds, pages, _predictor(spark, sf_dir), blocklist=BLOCKED, max_pages=10**6, growth_factor=None, source=PAGE_SOURCE)


@query(
    "filter_seeds_job",
    f"""WITH {SQL_SEEDS}, {SQL_HREFS}, {SQL_EDGES}, {SQL_PAGES_PREDICTED}, {SQL_FILTERED} SELECT lid_label, url AS link FROM filtered""",
)
def filter_seeds_job(spark, sf_dir):
    gated = filters.seed_gate(seed_table(spark, sf_dir)).filter(F.col("predicted_lid").isNotNull())
    seeds = gated.select("lid_label", F.col("link").alias("url"))
    pages = page_table(spark, sf_dir)
    from linkloom.operators.frontier import one_hop_links

    found = sets.set_union(seeds, one_hop_links(seeds, page_ops.page_links(pages).select("src", "dst")))
    links = found.withColumnRenamed("url", "link")
    return lid.filter_links(links, pages, _predictor(spark, sf_dir), 0.7, save_text=False, source=PAGE_SOURCE).select("lid_label", "link")


@query(
    "seed_expansion_job",
    f"""WITH {SQL_BLOCKLIST}, seeds0 AS ({SQL_SEEDS.split('AS (', 1)[1].rsplit(')', 1)[0]}),
    seeds AS (SELECT * FROM seeds0 WHERE {_ALLOWED.format('link')}),
    {SQL_HREFS}, {SQL_EDGES}, {SQL_PAGES_PREDICTED}, {SQL_FILTERED},
    given AS (SELECT lid_label, link AS url FROM seeds WHERE predicted_lid IS NOT NULL AND lid_confidence > 0.7),
    longform AS (SELECT lid_label, 'seed_urls' AS kind, url FROM given
      UNION ALL SELECT lid_label, 'all_website_links', url FROM found
      UNION ALL SELECT lid_label, 'filtered_links', url FROM filtered
      UNION ALL SELECT lid_label, 'unique_links', url FROM (SELECT * FROM filtered EXCEPT SELECT * FROM given)
      UNION ALL SELECT lid_label, 'rejected_links', url FROM (SELECT * FROM given EXCEPT SELECT * FROM filtered))
    SELECT * FROM longform""",
)
def seed_expansion_job(spark, sf_dir):
    return _expansion(spark, sf_dir).metadata


def _ingested(spark, sf_dir, predictor):
    folder = shared_path(spark, "ingest")
    rows = _turns(spark, sf_dir).withColumn("link", F.concat(F.lit("https://q.example.org/"), F.col("k").cast("string")))
    rows.write.json(f"{folder}/in")
    results = ingest.read_results(spark, f"{folder}/in", "k bigint, snippet string, link string")
    tag = lambda batch: ingest.tagged_results(batch, predictor, EXCLUDED, UNUSED)
    ingest.ingest(results, tag, f"{folder}/out", f"{folder}/state").awaitTermination()
    filed = spark.read.schema("k bigint, snippet string, predicted_lid string").json(f"{folder}/out")
    return filed.select("k", "snippet", "predicted_lid")


_INGESTED = f"WITH {SQL_TURNS_PREDICTED.format('text')} SELECT k, text AS snippet, predicted_lid FROM turns JOIN predicted USING (k) WHERE {_NOT_EXCLUDED}"


@query("incremental_ingest", _INGESTED)
def incremental_ingest(spark, sf_dir):
    return _ingested(spark, sf_dir, _predictor(spark, sf_dir))


@query("incremental_ingest_join", _INGESTED)
def incremental_ingest_join(spark, sf_dir):
    return _ingested(spark, sf_dir, lid.fit_profile(text_table(spark, sf_dir)))


@query(
    "incremental_ingest_pages",
    f"""WITH {SQL_LINKS}, {SQL_BLOCKLIST}, {SQL_PAGES_PREDICTED} SELECT ord, l.link, predicted_lid FROM links l
    JOIN predicted p ON p.link = l.link WHERE {_ALLOWED.format('l.link')} AND {_NOT_EXCLUDED}""",
)
def incremental_ingest_pages(spark, sf_dir):
    """Results whose pages are at hand, judged by the page."""
    folder, predictor, pages = shared_path(spark, "ingest"), _predictor(spark, sf_dir), page_table(spark, sf_dir)
    link_table(spark, sf_dir).select("ord", "link").write.json(f"{folder}/in")
    results = ingest.read_results(spark, f"{folder}/in", "ord bigint, link string")
    tag = lambda batch: ingest.tagged_results(batch, predictor, EXCLUDED, BLOCKED, pages, source=PAGE_SOURCE)
    ingest.ingest(results, tag, f"{folder}/out", f"{folder}/state").awaitTermination()
    filed = spark.read.schema("ord bigint, link string, predicted_lid string").json(f"{folder}/out")
    return filed.select("ord", "link", "predicted_lid")

"""Queries on corpora and character n-gram language models."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkloom.functions.text import WS
from linkloom.operators import lm
from linkloom.registry.base import LABELS, SQL_TEXTS, query, scattered, sql_label, table, text_table
from linkloom.session import stored

ORDER = 5


@query("label_corpus", f"WITH {SQL_TEXTS} SELECT lid_label, doc_id, text, length(text) AS n_chars FROM texts WHERE lid_label IN ('fra_Latn', 'deu_Latn')")
def label_corpus(spark, sf_dir):
    return lm.label_corpus(text_table(spark, sf_dir), ["fra_Latn", "deu_Latn"])


@query("text_len", f"WITH {SQL_TEXTS} SELECT lid_label, CAST(sum(length(text)) AS BIGINT) AS text_len FROM texts GROUP BY 1")
def text_len(spark, sf_dir):
    return lm.corpus_lengths(text_table(spark, sf_dir))


@query(
    "truncate_min",
    f"""WITH {SQL_TEXTS}, least AS (SELECT min(n) AS n FROM (SELECT sum(length(text)) AS n FROM texts GROUP BY lid_label)),
    run AS (SELECT *, sum(length(text)) OVER (PARTITION BY lid_label ORDER BY doc_id) - length(text) AS before FROM texts)
    SELECT lid_label, doc_id, substr(text, 1, CAST(n - before AS BIGINT)) AS text FROM run CROSS JOIN least WHERE n > before""",
)
def truncate_min(spark, sf_dir):
    return lm.truncate_to_shortest(text_table(spark, sf_dir))


@query(
    "truncate_min_sparse",
    f"""WITH {SQL_TEXTS}, least AS (SELECT min(n) AS n FROM (SELECT sum(length(text)) AS n FROM texts GROUP BY lid_label)),
    placed AS (SELECT lid_label, doc_id * 1000003 % 2147483647 AS doc_id, text FROM texts),
    run AS (SELECT *, sum(length(text)) OVER (PARTITION BY lid_label ORDER BY doc_id) - length(text) AS before FROM placed)
    SELECT lid_label, doc_id, substr(text, 1, CAST(n - before AS BIGINT)) AS text FROM run CROSS JOIN least WHERE n > before""",
)
def truncate_min_sparse(spark, sf_dir):
    """Documents in the order of scattered ids."""
    return lm.truncate_to_shortest(text_table(spark, sf_dir).withColumn("doc_id", scattered(F.col("doc_id"))))


SQL_COUNTS = f"""{SQL_TEXTS}, sent AS (SELECT lid_label, doc_id,
    list_concat(list_concat(['<s>'], list_filter(string_split(regexp_replace(text, '{WS}+', '', 'g'), ''), lambda x: x <> '')), ['</s>']) AS s FROM texts),
  toks AS (SELECT lid_label, doc_id, unnest(s) AS t1, unnest(range(1, len(s) + 1)) AS i FROM sent),
  runs AS (SELECT *, lead(t1, 1) OVER w AS t2, lead(t1, 2) OVER w AS t3, lead(t1, 3) OVER w AS t4, lead(t1, 4) OVER w AS t5
    FROM toks WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
  counts AS ({" UNION ALL ".join(
    f"SELECT lid_label, {n} AS n, concat_ws(' ', {', '.join(f't{k}' for k in range(1, n + 1))}) AS ngram, count(*) AS cnt "
    f"FROM runs WHERE t{n} IS NOT NULL GROUP BY ALL" for n in range(1, ORDER + 1))})"""


def _counts(spark, sf_dir):
    return lm.ngram_counts(text_table(spark, sf_dir), ORDER)


@query("ngram_counts", f"WITH {SQL_COUNTS} SELECT lid_label, n, ngram, cnt FROM counts")
def ngram_counts(spark, sf_dir):
    return _counts(spark, sf_dir).select("lid_label", "n", lm.shown("gram").alias("ngram"), "cnt")


SQL_ADJUSTED = f"""{SQL_COUNTS}, adjusted AS (
  SELECT lid_label, n, ngram, cnt AS adj FROM counts WHERE n = {ORDER} OR starts_with(ngram, '<s>')
  UNION ALL SELECT lid_label, n - 1, regexp_replace(ngram, '^[^ ]+ ?', ''), count(*)
    FROM counts WHERE n > 1 GROUP BY ALL)"""


@query("kn_adjusted_counts", f"WITH {SQL_ADJUSTED} SELECT * FROM adjusted")
def kn_adjusted_counts(spark, sf_dir):
    adjusted = lm.adjusted_counts(stored(_counts(spark, sf_dir), "counts", ("n",)), ORDER)
    return adjusted.select("lid_label", "n", lm.shown("gram").alias("ngram"), "adj")


SQL_DISCOUNTS = f"""{SQL_ADJUSTED}, told AS (SELECT * FROM adjusted WHERE ngram <> '<s>'),
  tally AS (SELECT lid_label, n, count(*) FILTER (WHERE adj = 1) AS t1, count(*) FILTER (WHERE adj = 2) AS t2,
    count(*) FILTER (WHERE adj = 3) AS t3, count(*) FILTER (WHERE adj = 4) AS t4 FROM told GROUP BY ALL),
  raw AS (SELECT lid_label, n, t1, t2, t3, t1 / (t1 + 2.0 * t2) AS y, 1 - 2 * y * t2 / nullif(t1, 0) AS r1,
    2 - 3 * y * t3 / nullif(t2, 0) AS r2, 3 - 4 * y * t4 / nullif(t3, 0) AS r3 FROM tally),
  judged AS (SELECT *, coalesce(t1 > 0 AND t2 > 0 AND t3 > 0 AND r1 BETWEEN 0 AND 1 AND r2 BETWEEN 0 AND 2 AND r3 BETWEEN 0 AND 3, false) AS ok FROM raw),
  rates AS (SELECT lid_label, n, CAST(CASE WHEN ok THEN r1 ELSE 0.5 END AS DOUBLE) AS d1,
    CAST(CASE WHEN ok THEN r2 ELSE 1 END AS DOUBLE) AS d2, CAST(CASE WHEN ok THEN r3 ELSE 1.5 END AS DOUBLE) AS d3 FROM judged)"""


@query("kn_discounts", f"WITH {SQL_DISCOUNTS} SELECT lid_label, n, round(d1, 6) AS d1, round(d2, 6) AS d2, round(d3, 6) AS d3 FROM rates")
def kn_discounts(spark, sf_dir):
    found = lm.discounts(lm.adjusted_counts(stored(_counts(spark, sf_dir), "counts", ("n",)), ORDER))
    return found.select("lid_label", "n", *[F.round(d, 6).alias(d) for d in ("d1", "d2", "d3")])


# One joint key per join: with label and text apart, the planner may join contexts and suffixes by label alone.
_LEVELS = ", ".join(
    f"""p{n} AS (SELECT f.lid_label, f.ngram, f.k, own + gamma * p.prob AS prob FROM own f
      JOIN p{n - 1} p ON p.k = f.suffix_k WHERE f.n = {n})"""
    for n in range(2, ORDER + 1)
)
_UNION = " UNION ALL ".join(f"SELECT lid_label, {n} AS n, ngram, prob FROM p{n}" for n in range(1, ORDER + 1))
SQL_MODEL = f"""{SQL_DISCOUNTS},
  freed AS MATERIALIZED (SELECT t.*, CASE adj WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END AS d,
      t.lid_label || '|' || t.n || '|' || regexp_replace(ngram, ' ?[^ ]+$', '') AS context_k
    FROM told t JOIN rates r ON r.lid_label || r.n = t.lid_label || t.n),
  ctx AS MATERIALIZED (SELECT context_k, sum(adj) AS total, sum(d) / sum(adj) AS gamma FROM freed GROUP BY ALL),
  own AS MATERIALIZED (SELECT f.lid_label, f.n, f.ngram, f.lid_label || '|' || f.ngram AS k,
      f.lid_label || '|' || regexp_replace(f.ngram, '^[^ ]+ ?', '') AS suffix_k, (adj - d) / total AS own, gamma
    FROM freed f JOIN ctx c ON c.context_k = f.context_k),
  vocab AS (SELECT lid_label, count(*) + 1 AS v, max(gamma) AS gamma FROM own WHERE n = 1 GROUP BY lid_label),
  p1 AS (SELECT f.lid_label, f.ngram, f.k, own + f.gamma / v AS prob FROM own f JOIN vocab w ON w.lid_label = f.lid_label WHERE f.n = 1
    UNION ALL SELECT lid_label, '<unk>', lid_label || '|<unk>', gamma / v FROM vocab),
  {_LEVELS},
  probs AS ({_UNION} UNION ALL SELECT lid_label, 1, '<s>', NULL FROM vocab),
  model AS (SELECT p.lid_label, p.n, p.ngram, log10(prob) AS log10_prob, coalesce(log10(gamma), 0) AS log10_backoff FROM probs p
    LEFT JOIN ctx c ON c.context_k = p.lid_label || '|' || (p.n + 1) || '|' || p.ngram)"""


def _model(spark, sf_dir):
    return lm.kn_model(stored(_counts(spark, sf_dir), "counts", ("n",)), ORDER)


@query("kn_model", f"WITH {SQL_MODEL} SELECT lid_label, n, ngram, round(log10_prob, 5) AS log10_prob, round(log10_backoff, 5) AS log10_backoff FROM model")
def kn_model(spark, sf_dir):
    rounded = [F.round(c, 5).alias(c) for c in ("log10_prob", "log10_backoff")]
    return _model(spark, sf_dir).select("lid_label", "n", lm.shown("gram").alias("ngram"), *rounded)


# Texts that the model has not seen: benchmark items under the label of their number, with unknown characters.
_ASKED = f"""asked AS (SELECT item_id AS doc_id, {sql_label("['en', 'fr', 'de', 'es'][item_id % 4 + 1]")} AS lid_label, text || ' ωψ' AS text FROM benchmark),
  said AS (SELECT lid_label, doc_id, list_concat(list_concat(['<s>'],
      list_filter(string_split(regexp_replace(text, '{WS}+', '', 'g'), ''), lambda x: x <> '')), ['</s>']) AS s FROM asked),
  spots AS (SELECT lid_label, doc_id, s, unnest(range(2, len(s) + 1)) AS i FROM said),
  windows AS (SELECT lid_label, doc_id, list_slice(s, greatest(i - {ORDER - 1}, 1), i) AS w FROM spots),
  looked AS (SELECT lid_label, w, count(*) AS c, doc_id FROM windows GROUP BY ALL),
  forms AS (SELECT DISTINCT lid_label, w FROM looked),
  known AS (SELECT f.lid_label, f.w, max(m.n) AS n FROM (SELECT lid_label, w, unnest(range(1, len(w) + 1)) AS k FROM forms) f
    JOIN model m ON m.lid_label = f.lid_label AND m.ngram = array_to_string(list_slice(f.w, len(f.w) - f.k + 1, len(f.w)), ' ')
    WHERE m.log10_prob IS NOT NULL GROUP BY ALL),
  based AS (SELECT f.lid_label, f.w, coalesce(k.n, 1) AS n, m.log10_prob AS p FROM forms f LEFT JOIN known k ON k.lid_label = f.lid_label AND k.w = f.w
    JOIN model m ON m.lid_label = f.lid_label AND m.ngram =
      CASE WHEN k.n IS NULL THEN '<unk>' ELSE array_to_string(list_slice(f.w, len(f.w) - k.n + 1, len(f.w)), ' ') END),
  paid AS (SELECT b.lid_label, b.w, sum(m.log10_backoff) AS back FROM (SELECT lid_label, w, n, unnest(range(n, len(w))) AS k FROM based) b
    JOIN model m ON m.lid_label = b.lid_label AND m.ngram = array_to_string(list_slice(b.w, len(b.w) - b.k, len(b.w) - 1), ' ') GROUP BY ALL),
  costs AS (SELECT b.lid_label, b.w, p + coalesce(back, 0) AS logp FROM based b LEFT JOIN paid USING (lid_label, w))"""


@query(
    "lm_perplexity",
    f"""WITH {SQL_MODEL}, {_ASKED} SELECT doc_id, l.lid_label, CAST(sum(c) AS BIGINT) AS n_tokens, round(sum(c * logp), 4) AS log10_prob,
      round(pow(10, -sum(c * logp) / sum(c)), 4) AS perplexity
    FROM looked l JOIN costs USING (lid_label, w) GROUP BY ALL""",
)
def lm_perplexity(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark")
    iso = F.get(F.array(*[F.lit(v) for v in LABELS.values()]), F.col("item_id") % 4)
    asked = items.select(F.col("item_id").alias("doc_id"), iso.alias("lid_label"), F.concat("text", F.lit(" ωψ")).alias("text"))
    scored = lm.score_documents(asked, stored(_model(spark, sf_dir), "model", ("n",)), ORDER)
    return scored.select("doc_id", "lid_label", "n_tokens", F.round("log10_prob", 4).alias("log10_prob"), F.round("perplexity", 4).alias("perplexity"))

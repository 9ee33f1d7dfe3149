"""Exact dedup with a heavy-hitter split.

A Misra-Gries summary (Spark's frequent-items aggregate, whose state is bounded
and merged before any shuffle) names the digests that may be frequent. Their
exact counts and winners are worked out with map-side combining, at most
``PARTS`` rows, and sent to all tasks, which then remove the losing copies where
they lie. What is left, the winners and all other digests, goes through one
ordinary shuffle on the digest; no digest there has more than a ``PARTS``-th of the rows.

Only DataFrame functions are used.

Defined cases: a null text counts as empty, and all texts without visible
characters equal each other; a null id loses against any other; of rows that
repeat in text and id exactly one stays; an empty table gives an empty result;
further columns, whatever their names, pass through ``drop_copies`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from linkloom.session import stored

# Characters that do not count: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"

# A digest is heavy when it holds at least this part of the rows.
PARTS = 1000
# Digests that the summary follows; its error is at most rows / (0.75 * TRACKED).
TRACKED = 8192


def keyed(docs: DataFrame, id: str = "doc_id", text: str = "text", carry: bool = True) -> DataFrame:
    """``digest``, ``chars`` (code points), ``id`` and, with ``carry``, the whole row in ``row``."""
    body = F.coalesce(docs[text], F.lit(""))
    columns = [
        F.sha2(F.translate(body, BLANKS, ""), 256).alias("digest"),
        F.length(body).alias("chars"),
        docs[id].alias("id"),
    ]
    if carry:
        columns.append(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    return docs.select(*columns)


def _rank() -> Column:
    """Sorts the row that stays first: most code points, then the smallest id, nulls last."""
    return F.struct((-F.col("chars")).alias("chars"), F.col("id").isNull().alias("unnamed"), F.col("id").alias("id"))


def heavy_winners(light: DataFrame) -> DataFrame:
    """``digest``, ``size``, ``best``: the verified heavy digests, at most ``PARTS`` rows."""
    # Frequent-items aggregate: a Misra-Gries summary for each task, merged into one.
    summary = stored(
        light.agg(F.count("*").alias("rows"), F.expr(f"approx_top_k(digest, {PARTS}, {TRACKED})").alias("top")),
        "frequent",
    )
    suspects = summary.select("rows", F.explode("top").alias("found")).select("rows", F.col("found.item").alias("digest"))
    exact = (
        light.join(F.broadcast(suspects), "digest")
        .groupBy("digest")
        .agg(F.count("*").alias("size"), F.min(_rank()).alias("best"), F.first("rows").alias("rows"))
    )
    return stored(exact.where((F.col("size") > 1) & (F.col("size") * PARTS >= F.col("rows"))).drop("rows"), "heavy")


def _split(rows: DataFrame, heavy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that a heavy digest's winner removes, and all others."""
    marked = rows.join(F.broadcast(heavy), "digest", "left")
    lost = F.col("size").isNotNull() & ~F.col("best").eqNullSafe(_rank())
    return marked.where(lost), marked.where(~lost)


def _settle(rows: DataFrame) -> DataFrame:
    """Verdicts on what the map side left, by an ordinary shuffle on the digest."""
    group = Window.partitionBy("digest")
    ranked = group.orderBy(_rank())
    return rows.withColumns(
        {
            "keep_id": F.first("id").over(ranked),
            "group_size": F.coalesce("size", F.count("*").over(group)),
            "kept": F.row_number().over(ranked) == 1,
        }
    )


def mark_copies(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: ``id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    light = stored(keyed(docs, id, text, carry=False), "digests")
    lost, rest = _split(light, heavy_winners(light))
    lost = lost.withColumns({"keep_id": F.col("best.id"), "group_size": F.col("size"), "kept": F.lit(False)})
    columns = ["id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")]
    return _settle(rest).select(*columns).unionByName(lost.select(*columns))


def drop_copies(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with the columns of ``docs``; losing heavy copies are never shuffled."""
    heavy = heavy_winners(stored(keyed(docs, id, text, carry=False), "digests"))
    rest = _split(keyed(docs, id, text), heavy)[1]
    return _settle(rest).where("kept").select("row.*")

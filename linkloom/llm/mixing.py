"""Temperature mixing of sources, realised as budgeted block permutations.

A source's weight is its token share raised to an exponent in [0, 1], normalised: 1
keeps the natural shares, 0 makes all sources equal. Bisection finds the smallest
exponent, to 20 bits, at which the weights' entropy is at most ``entropy`` times
its greatest value and no source is repeated more than ``max_repeats`` times; one pass over the
short table of sources judges 32 exponents, five bisection steps, at once.

A source's quota is its weight times the budget. Its documents are read in a new
permutation, by hash, on every pass, and each is taken while the tokens read before it are
below the quota. Place ``c`` of quota ``q`` goes to block ``c * blocks / q``, so every
block holds the sources by their weights; a second hash permutes each block.

Running token counts need no task with a whole source: documents are summed by
(source, pass, first hash digits), at most ``16 ** DIGITS`` sums for a source and pass, and run
up inside one such group only. Places in a block are counted in the same way.

Only DataFrame functions are used.

Defined cases: a null source is a source of its own; a null text has no tokens; documents
of a source without any tokens are taken once, in block 0; other documents without
tokens are taken where their turn comes; rows that repeat are separate documents; an empty
table gives an empty result; all columns pass in ``row``, so their names never clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from linkloom.session import stored

WORD = r"[^\x20\x09-\x0D]+"
# Hash digits (base 16) that split a source and pass for its running sums.
DIGITS = 3
# Exponents judged in one pass, and passes: 32 ** 4 steps of the exponent.
WAYS, ROUNDS = 32, 4
# Budget: as many tokens as the corpus has.
ALL = -1


def with_tokens(docs: DataFrame, id: str, text: str, source: str, carry: bool) -> DataFrame:
    columns = [
        docs[id].alias("id"),
        docs[source].alias("source"),
        F.coalesce(F.regexp_count(docs[text], F.lit(WORD)), F.lit(0)).cast("long").alias("tokens"),
    ]
    if carry:
        columns.append(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    return docs.select(*columns)


def source_shares(rows: DataFrame) -> DataFrame:
    """``source``, ``total`` (tokens), ``share``: one row for each source, stored."""
    totals = stored(rows.groupBy("source").agg(F.sum("tokens").alias("total")), "sources")
    whole = totals.agg(F.sum("total")).first()[0] or 0
    return totals.withColumn("share", F.col("total") / F.lit(max(whole, 1)))


def find_exponent(shares: DataFrame, entropy: float, max_repeats: float, budget: int | None) -> tuple[float, float, float]:
    """The exponent, the sum of shares raised to it, and the budget.

    ``ALL`` stands for the tokens of the corpus; without a ``budget`` it is the least under which every source is read whole once.
    """
    counted = shares.where("total > 0")
    size = counted.agg(F.count("*").alias("n"), F.sum("total").alias("t"), F.min("share").alias("p")).first()
    if not size["n"]:
        return 1.0, 1.0, 0.0
    budget = size["t"] if budget == ALL else budget

    def judged(low: int, step: int) -> list:
        """The sum of powers and the entropy at ``WAYS`` + 1 exponents from ``low``."""
        steps = F.explode(F.sequence(F.lit(0), F.lit(WAYS)))
        powers = counted.select("share", steps.alias("k")).withColumn(
            "power", F.pow("share", (F.lit(low) + F.col("k") * F.lit(step)) / F.lit(float(WAYS**ROUNDS)))
        )
        return (
            powers.groupBy("k")
            .agg(F.sum("power").alias("z"), F.sum(F.col("power") * F.ln("share")).alias("l"), F.max("share").alias("most"))
            .orderBy("k")
            .collect()
        )

    def fits(point, alpha: float) -> bool:
        z = point["z"]
        bits = math.log(z) - alpha * point["l"] / z
        times = size["p"] ** (alpha - 1)  # passes over the smallest source, by those over the whole corpus
        whole = point["most"] ** (alpha - 1)
        spent = times / whole if budget is None else times / z * budget / size["t"]
        return bits <= entropy * math.log(size["n"]) + 1e-12 and spent <= max_repeats + 1e-12

    low, step = 0, WAYS ** (ROUNDS - 1)
    for _ in range(ROUNDS):
        points = judged(low, step)
        # The least exponent that fits, or 1, lies in the step before it.
        first = next((p["k"] for p in points if fits(p, (low + p["k"] * step) / WAYS**ROUNDS)), WAYS)
        found = points[first]
        at = low + first * step
        low, step = max(low, at - step), max(step // WAYS, 1)
    alpha = at / WAYS**ROUNDS
    spend = budget if budget is not None else size["t"] * found["z"] * found["most"] ** (1 - alpha)
    return alpha, found["z"], float(spend)


def _order(seed: int, what: str, *parts: Column) -> Column:
    cells = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws(":", F.lit(f"{seed}{what}"), *cells))


def mix(
    docs: DataFrame,
    entropy: float = 1.0,
    max_repeats: float = 4.0,
    budget: int | None = None,
    block_tokens: int = 1 << 16,
    seed: int = 17,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    carry: bool = True,
) -> DataFrame:
    """The documents taken: ``id``, ``source``, ``tokens``, ``quota``, ``pass``, ``block``, and ``row``."""
    rows = with_tokens(docs, id, text, source, carry)
    if not carry:
        rows = stored(rows, "tokens")
    shares = source_shares(rows)
    alpha, z, spend = find_exponent(shares, entropy, max_repeats, budget)
    blocks = max(1, -(-int(spend) // block_tokens))
    quota = F.floor(F.pow("share", F.lit(alpha)) / F.lit(z) * F.lit(spend))
    if budget is None:
        # The source that sets the budget is read whole, whatever the rounding.
        quota = F.greatest(quota, F.col("total"))
    quotas = shares.select(F.col("source").alias("of"), "total", F.when(F.col("total") > 0, quota).alias("quota"))
    passes = F.when(F.col("total") > 0, F.greatest(F.ceil(F.col("quota") / F.col("total")), F.lit(1))).otherwise(1)
    read = rows.join(quotas, F.col("source").eqNullSafe(F.col("of"))).withColumn(
        "pass", F.explode(F.sequence(F.lit(0).cast("long"), passes.cast("long") - 1))
    )
    read = read.withColumn("order", _order(seed, "", F.col("pass"), F.col("id")))
    read = read.withColumn("cell", F.substring("order", 1, DIGITS))
    # One key that is never null, so that window and join share one shuffle; no source looks like the null one.
    named = F.coalesce(F.concat(F.lit("="), F.col("of").cast("string")), F.lit(""))
    read = read.withColumn("slice", F.concat_ws(":", "pass", "cell", named))
    # At most 16 ** DIGITS rows for each source and pass.
    earlier = Window.partitionBy("of", "pass").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        read.groupBy("of", "pass", "cell", "slice")
        .agg(F.sum("tokens").alias("n"))
        .select("slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    )
    inside = Window.partitionBy("slice").orderBy("order", "id", "tokens")
    so_far = F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    placed = (
        read.withColumn("inside", F.coalesce(so_far, F.lit(0)))
        .join(cells, "slice")
        .withColumn("at", F.col("pass") * F.col("total") + F.col("start") + F.col("inside"))
    )
    # Documents without tokens cost nothing, so one at the very end is taken too.
    fits = (F.col("at") < F.col("quota")) | ((F.col("tokens") == 0) & (F.col("at") <= F.col("quota")))
    taken = placed.where((F.col("total") == 0) | fits)
    block = F.expr(f"least(cast((cast(at as decimal(20,0)) * {blocks}) div quota as long), {blocks - 1}L)")
    return taken.select(
        "id",
        "source",
        "tokens",
        F.coalesce("quota", F.lit(0)).cast("long").alias("quota"),
        "pass",
        F.when(F.col("total") > 0, block).otherwise(0).alias("block"),
        *(["row"] if carry else []),
    )


def with_slots(taken: DataFrame, seed: int = 17) -> DataFrame:
    """``slot``: the place in a permutation of each block, which holds about ``block_tokens`` tokens."""
    # A block bounds tokens, not rows: documents without tokens may all be in one. So it is numbered by hash digits.
    columns = taken.columns
    placed = taken.withColumn("place", _order(seed, "b", F.col("pass"), F.col("id")))
    placed = stored(placed.withColumn("cell", F.substring("place", 1, DIGITS)), "taken")
    placed = placed.withColumn("slice", F.concat_ws(":", "block", "cell"))
    # At most 16 ** DIGITS rows for each block.
    earlier = Window.partitionBy("block").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        placed.groupBy("block", "cell", "slice")
        .agg(F.count("*").alias("n"))
        .select("slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    )
    inside = Window.partitionBy("slice").orderBy("place", "id", "source", "tokens")
    numbered = placed.withColumn("inside", F.row_number().over(inside)).join(cells, "slice")
    return numbered.select(*columns, (F.col("first") + F.col("inside") - 1).alias("slot"))


def mix_documents(docs: DataFrame, seed: int = 17, **options) -> DataFrame:
    """The documents taken, with the columns of ``docs``, as often as they are read, in the order of block and slot."""
    taken = mix(docs, seed=seed, **options).withColumn("place", _order(seed, "b", F.col("pass"), F.col("id")))
    order = ["block", "place", "id", "source", "tokens"]
    return taken.repartitionByRange(*order).sortWithinPartitions(*order).select("row.*")

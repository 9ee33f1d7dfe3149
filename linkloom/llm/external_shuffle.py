"""Two-pass external shuffle into shards.

Pass one scatters records by a seeded hash, uniformly, into buckets of about
``bucket_bytes`` that fit a task's memory. Pass two shuffles each bucket by
Fisher-Yates (Spark's ``shuffle``) and writes it. A record's place overall is the number
of records in earlier buckets plus its place in its own; shard ``s`` of ``S`` is the
``s``-th run of places, so shard sizes differ by one row at most.

Only DataFrame functions are used. The result depends on the rows, the seed and
``bucket_bytes`` alone: buckets are sorted before they are shuffled, and the random
numbers of a task run through its buckets in their order. A task that is run
again writes the same records.

Defined cases: a null text has size 8 like an empty one; null ids are hashed as nulls;
equal texts spread by their ids; rows that repeat in id and text share a bucket and
take places next to chance; an empty table gives no files and an empty result. Columns of
any name pass through in ``row``; types that cannot be sorted (maps) are not taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from linkloom.session import shared_path

# Bytes of text in a bucket: what one task holds in memory, a few times over.
BUCKET_BYTES = 8 << 20


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text, and eight for the id."""
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long") + 8


def scattered(docs: DataFrame, buckets: int, seed: int, id: str, text: str) -> DataFrame:
    place = F.xxhash64(F.lit(seed), docs[id], docs[text])
    return docs.select(
        F.pmod(place, F.lit(buckets)).alias("bucket"),
        # Another hash than the bucket's own orders the rows before the shuffle.
        F.struct(
            F.xxhash64(F.lit(seed + 1), docs[id], docs[text]).alias("key"),
            F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        ).alias("record"),
    )


def shuffled(
    docs: DataFrame,
    shards: int = 24,
    seed: int = 20240607,
    bucket_bytes: int = BUCKET_BYTES,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``shard``, ``slot`` (gapless from 0 in each shard) and ``row``, in a random order."""
    total = docs.agg(F.sum(record_size(docs[text])).alias("bytes"), F.count("*").alias("rows")).first()
    rows, buckets = total["rows"], max(1, -(-(total["bytes"] or 0) // bucket_bytes))
    scatter = scattered(docs, buckets, seed, id, text)
    # One short row for each bucket: rows before it.
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        scatter.groupBy("bucket")
        .agg(F.count("*").alias("n"))
        .select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    gathered = (
        scatter.repartition(buckets, "bucket")
        .groupBy("bucket")
        .agg(F.sort_array(F.collect_list("record")).alias("records"))
    )
    # The buckets of a task in order, so that each meets the same random numbers on every run; mixed ahead of
    # the join, whose form may change from run to run.
    mixed = gathered.sortWithinPartitions("bucket").select("bucket", F.shuffle("records", seed).alias("records"))
    placed = mixed.join(starts, "bucket").select("start", F.posexplode("records").alias("i", "record"))
    at = placed.select((F.col("start") + F.col("i")).alias("at"), F.col("record.row").alias("row"))
    rows = max(rows, 1)
    shard = F.expr(f"((at + 1) * {shards} - 1) div {rows}").cast("int")
    slot = F.expr(f"at - (shard * {rows}L) div {shards}")
    return at.withColumn("shard", shard).select("shard", slot.alias("slot"), "row")


def write_shards(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the shuffled rows as Parquet, a folder for each shard, and read them back."""
    path = path or shared_path(docs.sparkSession, "shards")
    result = shuffled(docs, **options)
    # A bucket lies in few shards, so each task writes few files.
    result.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(result.schema).parquet(path)

"""Set algebra on per-label URL lists and the statistics drawn from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

KINDS = (
    "seed_urls",
    "all_website_links",
    "filtered_links",
    "unique_links",
    "rejected_links",
    "active_seed_urls",
)


def distinct_urls(df: DataFrame, keys: list[str], url: str = "url") -> DataFrame:
    return df.select(*keys, url).distinct()


def set_minus(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that are not in ``right``."""
    return left.subtract(right.select(*left.columns))


def set_union(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right.select(*left.columns)).distinct()


def concatenate(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both inputs one after the other, repeats kept."""
    return left.unionByName(right.select(*left.columns))


def crawl_metadata(seeds: DataFrame, all_links: DataFrame, filtered: DataFrame) -> DataFrame:
    """Long form (lid_label, kind, url) of the URL lists of a crawl.

    All inputs are (lid_label, url). Seeds keep repeats, as in the seed file;
    the other lists are sets. New and rejected links come out of one full view of
    each URL's memberships, so no list is shuffled twice.
    """
    member = seeds.select("lid_label", "url", F.lit(1).alias("s"), F.lit(0).alias("f")).unionByName(
        filtered.select("lid_label", "url", F.lit(0).alias("s"), F.lit(1).alias("f"))
    )
    sides = member.groupBy("lid_label", "url").agg(F.max("s").alias("s"), F.max("f").alias("f"))
    compared = sides.filter(F.col("s") != F.col("f")).select(
        "lid_label",
        F.when(F.col("f") == 1, F.lit("unique_links")).otherwise(F.lit("rejected_links")).alias("kind"),
        "url",
    )
    return (
        seeds.select("lid_label", F.lit("seed_urls").alias("kind"), "url")
        .unionByName(all_links.select("lid_label", F.lit("all_website_links").alias("kind"), "url").distinct())
        .unionByName(filtered.select("lid_label", F.lit("filtered_links").alias("kind"), "url"))
        .unionByName(compared)
    )


def add_active_seeds(metadata: DataFrame) -> DataFrame:
    """Append the seeds that were not rejected, each once per label."""
    seeds = metadata.filter(F.col("kind") == "seed_urls").select("lid_label", "url")
    rejected = metadata.filter(F.col("kind") == "rejected_links").select("lid_label", "url")
    active = set_minus(seeds, rejected).select("lid_label", F.lit("active_seed_urls").alias("kind"), "url")
    return metadata.unionByName(active)


def crawl_counts(seeds: DataFrame, all_links: DataFrame, filtered: DataFrame) -> DataFrame:
    """``crawl_stats`` straight from the lists: each URL's memberships are looked at once."""
    lists = {"s": seeds, "a": all_links, "f": filtered}
    flags = [
        df.select("lid_label", "url", *[F.lit(int(k == name)).alias(k) for k in lists]) for name, df in lists.items()
    ]
    each = flags[0].unionByName(flags[1]).unionByName(flags[2])
    urls = each.groupBy("lid_label", "url").agg(*[F.sum(k).alias(k) for k in lists])
    s, a, f = (F.col(k) for k in lists)
    lengths = {
        "seed_urls": F.sum(s),
        "all_website_links": F.count_if(a > 0),
        "filtered_links": F.sum(f),
        "unique_links": F.count_if((f > 0) & (s == 0)),
        "rejected_links": F.count_if((s > 0) & (f == 0)),
        "active_seed_urls": F.count_if((s > 0) & (f > 0)),
    }
    return urls.groupBy("lid_label").agg(*[lengths[kind].alias(f"{kind}_len") for kind in KINDS])


def crawl_stats(metadata: DataFrame) -> DataFrame:
    """One row per label with the length of each list."""
    counts = [F.count_if(F.col("kind") == kind).alias(f"{kind}_len") for kind in KINDS]
    return metadata.groupBy("lid_label").agg(*counts)

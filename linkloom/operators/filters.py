"""Filters and predicates on links, labels and confidences."""

from __future__ import annotations

import uuid
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linkloom.constants import MAX_URL_LENGTH, MIN_CONFIDENCE
from linkloom.functions import urls
from linkloom.session import stored

LITERAL_LIMIT = 500
# Slices of all hosts that a seed without a host meets.
SLICES = 64
# Pairs of links and keys of a host in one slice, and the most tasks that slices are dealt out to.
PAIRS = 1_000_000
MOST_TASKS = 10_000


def minimal_entries(entries: list[str]) -> list[str]:
    """Blocklist without blank entries and without those another entry already implies."""
    distinct = list(dict.fromkeys(e.strip() for e in entries if e and e.strip()))
    return [e for e in distinct if not any(o != e and o in e for o in distinct)]


def is_blocked(link: Column | str, entries: list[str]) -> Column:
    """True when a blocklist entry is a case-sensitive substring of the link."""
    link = F.col(link) if isinstance(link, str) else link
    tests = [F.contains(link, F.lit(e)) for e in minimal_entries(entries)]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def blocklist_filter(df: DataFrame, entries: list[str] | DataFrame, link: str = "link") -> DataFrame:
    """Keep rows with a link that no entry is part of.

    A short list becomes a chain of tests; a table (entry) or a longer list becomes automata or is joined, with the same
    result.
    """
    if isinstance(entries, list):
        if len(entries) <= LITERAL_LIMIT:
            return df.filter(F.col(link).isNotNull() & ~is_blocked(link, entries))
        listed = [(e.strip(),) for e in entries if e]
        entries = df.sparkSession.createDataFrame(listed, "entry string")
    return blocklist_antijoin(df, entries, link)


def _distinct_runs(text: Column, n: int) -> Column:
    # URLs are short, so cutting them by substring is cheap.
    last = F.length(text) - (n - 1)
    runs = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(text, i, F.lit(n)))
    return F.when(last >= 1, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


# Entries of one automaton, and characters in all of them; automata that are sent to tasks for one list.
AUTOMATON_ENTRIES = 50_000
AUTOMATON_CHARS = 2_000_000
AUTOMATA = 16
_automata: dict[int, object] = {}


def blocklist_antijoin(df: DataFrame, blocklist: DataFrame, link: str = "link", entry: str = "entry") -> DataFrame:
    """``blocklist_filter`` for a blocklist too long for literals.

    The list is split by hash into automata of bounded size (Aho-Corasick), each sent to the tasks, where a link is read once by
    each: rows are neither exploded nor moved. A list too large for ``AUTOMATA`` of them is met by equi-joins instead,
    with the same result.
    """
    named = blocklist.select(F.trim(entry).alias("__entry")).filter(F.length("__entry") > 0).distinct()
    entries = stored(named, "blocklist")
    n, chars = entries.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("__entry")), F.lit(0))).first()
    rows = df.filter(F.col(link).isNotNull())
    # Parts by hash differ in size; two thirds of the bound leave room for that.
    parts = max(-(-3 * n // (2 * AUTOMATON_ENTRIES)), -(-3 * chars // (2 * AUTOMATON_CHARS)))
    if parts > AUTOMATA:
        return _antijoin_by_runs(rows, entries, link)
    for part in range(parts):
        some = entries if parts == 1 else entries.filter(F.pmod(F.xxhash64("__entry"), F.lit(parts)) == part)
        listed = [r[0] for r in some.collect()]
        rows = rows.filter(~_holds_any(F.col(link), listed)) if listed else rows
    return rows


def _holds_any(text: Column, entries: list[str]) -> Column:
    """Whether one of a bounded list of entries is part of the text."""
    sent = SparkSession.active().sparkContext.broadcast(entries)
    name = uuid.uuid4().hex

    @F.arrow_udf("boolean")
    def holds(texts: pa.Array) -> pa.Array:
        found = _automaton(name, sent)
        return pa.array([t is not None and next(found.iter(t), None) is not None for t in texts.to_pylist()], pa.bool_())

    return holds(text)


def _automaton(name: str, sent):
    """The automaton of a list, made once in each worker, which keeps those of one filter."""
    import ahocorasick

    if name not in _automata:
        made = ahocorasick.Automaton()
        for entry in sent.value:
            made.add_word(entry, True)
        made.make_automaton()
        while len(_automata) >= AUTOMATA:
            del _automata[next(iter(_automata))]
        _automata[name] = made
    return _automata[name]


def _antijoin_by_runs(rows: DataFrame, entries: DataFrame, link: str) -> DataFrame:
    """The filter as equi-joins.

    Each entry is filed under one of its character runs (the one with the least
    hash, which spreads entries with a common start); each distinct link is
    looked up under all of its runs and the candidates are verified.
    """
    distinct_links = rows.select(F.col(link).alias("__link")).distinct()

    def candidates(size: int, part: DataFrame) -> DataFrame:
        hashed = F.transform(_distinct_runs(F.col("__entry"), size), lambda r: F.struct(F.xxhash64(r), r.alias("run")))
        filed = part.select("__entry", F.array_min(hashed)["run"].alias("__run"))
        looked = distinct_links.select("__link", F.explode(_distinct_runs(F.col("__link"), size)).alias("__run"))
        return looked.join(filed, "__run").filter(F.contains("__link", "__entry")).select("__link")

    # Entries are taken by length class, so that each is filed under a run as telling as it allows.
    size = F.length("__entry")
    classes = {8: size >= 8, 3: (size >= 3) & (size < 8), 1: size < 3}
    # Links are cut only into runs of the lengths that entries are filed under.
    run = F.when(classes[8], 8).when(classes[3], 3).otherwise(1)
    found = sorted(r[0] for r in entries.select(run).distinct().collect())
    if not found:
        return rows
    blocked = reduce(DataFrame.unionByName, [candidates(n, entries.filter(classes[n])) for n in found])
    return rows.join(blocked.distinct(), rows[link] == blocked["__link"], "left_anti")


def filter_metadata(df: DataFrame, entries: list[str] | DataFrame, url: str = "url") -> DataFrame:
    """Blocklist on the long form of crawl metadata.

    An entry found in the host of ``http://`` + url is found in the url as well,
    so the host test adds nothing to the substring test.
    """
    return blocklist_filter(df, entries, url)


def exclude_labels(df: DataFrame, codes: DataFrame | list[str], label: str = "predicted_lid", code: str = "code") -> DataFrame:
    """Drop rows whose label is listed; a null label is kept."""
    if isinstance(codes, list):
        # A null in the list, as a failed lookup leaves it, excludes nothing.
        return df.filter(F.col(label).isNull() | ~F.col(label).isin([c for c in codes if c is not None]))
    listed = codes.select(F.col(code).alias("__code")).distinct()
    return df.join(listed, df[label] == listed["__code"], "left_anti")


def select_labels(df: DataFrame, labels: list[str] | DataFrame, label: str = "lid_label", code: str = "code") -> DataFrame:
    """Keep rows of the wanted labels: a batch list, or one desired label."""
    if isinstance(labels, list):
        return df.filter(F.col(label).isin(labels))
    wanted = labels.select(F.col(code).alias("__code")).distinct()
    return df.join(wanted, df[label] == wanted["__code"], "left_semi")


def seed_gate(df: DataFrame, minimum: float = MIN_CONFIDENCE, confidence: str = "lid_confidence") -> DataFrame:
    """Seeds need a confidence above the minimum; exactly the minimum is dropped."""
    return df.filter(F.col(confidence) > F.lit(minimum))


def language_gate(
    df: DataFrame,
    target: Column | str,
    minimum: float = MIN_CONFIDENCE,
    label: str = "predicted_lid",
    confidence: str = "lid_confidence",
) -> DataFrame:
    """Links need the target label and at least the minimum confidence."""
    target = F.col(target) if isinstance(target, str) else target
    return df.filter((F.col(label) == target) & (F.col(confidence) >= F.lit(minimum)))


def filter_by_key(df: DataFrame, key: str, value) -> DataFrame:
    """Rows whose ``key`` equals ``value``; a missing key equals None."""
    found = F.col(key) if key in df.columns else F.lit(None).cast("string")
    return df.filter(found.eqNullSafe(F.lit(value)))


def drop_empty(df: DataFrame, column: str = "iso_code") -> DataFrame:
    """Drop rows whose value is null or the empty string."""
    return df.filter(F.length(column) > 0)


def prune_null_values(mapping: Column | str) -> Column:
    """Map without its null values."""
    return F.map_filter(mapping, lambda _, value: value.isNotNull())


def prune_null_items(items: Column | str) -> Column:
    """Array of maps without null items, each item without its null values."""
    present = F.filter(items, lambda item: item.isNotNull())
    return F.transform(present, prune_null_values)


def extract_codes(df: DataFrame, columns: list[str], order: str) -> DataFrame:
    """Cells that contain ``_``, row by row and left to right."""
    cells = F.array(*[F.col(c).cast("string") for c in columns])
    return (
        df.select(order, F.posexplode(cells).alias("cell_no", "code"))
        .filter(F.contains("code", F.lit("_")))
    )


def same_site_hosts(hosts: DataFrame, seed_hosts: DataFrame, keys: list[str], host: str, seed_host: str) -> DataFrame:
    """Distinct ``(keys, host)`` where the host ends with one of the key's seed hosts.

    Works on distinct hosts, which are far fewer than links: each host is cut into
    its suffixes of the lengths that seed hosts have and equi-joined, so no pair is
    formed in vain. An empty seed host fits every host; its keys meet the hosts in slices.
    """
    distinct = hosts.select(host).distinct()
    seeds = stored(seed_hosts.select(*keys, F.col(seed_host).alias("__suffix")).distinct(), "seed-hosts")
    named, nameless = seeds.filter(F.col("__suffix") != ""), seeds.filter(F.col("__suffix") == "").drop("__suffix")
    # As many lengths as host names can have.
    lengths = sorted(r[0] for r in named.select(F.length("__suffix")).distinct().collect())
    sizes = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length(host))
    suffixes = F.transform(sizes, lambda n: F.substring(F.col(host), F.length(host) - n + 1, n))
    spread = distinct.withColumn("__suffix", F.explode(suffixes))
    found = spread.join(named, "__suffix").select(*keys, host)
    slices = F.lit(SLICES)
    anywhere = distinct.withColumn("__slice", F.pmod(F.xxhash64(host), slices).cast("int")).join(
        nameless.withColumn("__slice", F.explode(F.sequence(F.lit(0), slices - 1))), "__slice"
    )
    return found.unionByName(anywhere.select(*keys, host)).distinct()


def same_site_pairs(links: DataFrame, seeds: DataFrame, keys: list[str], link: str = "link", seed: str = "seed_url") -> DataFrame:
    """``(keys, *links)``: every link with every key whose seed's host its own host ends with.

    There are as many rows as pairs, so a host of many links and many keys has their product. Its links are dealt out by their
    hash to slices of about ``PAIRS`` pairs, each of which meets all keys of the host. The number of tasks follows the number of
    slices and not the size of the input, so a larger result has more tasks and not longer ones, up to ``MOST_TASKS``.
    """
    hosted = links.withColumn("__host", urls.netloc(link))
    hosts = seeds.select(*keys, urls.netloc(seed).alias("__seed_host"))
    fitting = stored(same_site_hosts(hosted, hosts, keys, "__host", "__seed_host"), "fitting")
    n_links = hosted.groupBy("__host").agg(F.count(F.lit(1)).alias("n_links"))
    pairs = F.col("n_links").cast("double") * F.col("n_keys")
    slices = F.least("n_links", F.ceil(pairs / PAIRS)).alias("slices")
    cuts = stored(fitting.groupBy("__host").agg(F.count(F.lit(1)).alias("n_keys")).join(n_links, "__host").select("__host", slices), "cuts")
    total = cuts.agg(F.sum("slices")).first()[0] or 0
    tasks = min(max(total, links.sparkSession.sparkContext.defaultParallelism), MOST_TASKS)
    place = ["__host", "__slice"]
    dealt = hosted.join(cuts, "__host").withColumn("__slice", F.pmod(F.xxhash64(*links.columns), "slices")).drop("slices")
    met = fitting.join(cuts, "__host").select(*keys, "__host", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)).alias("__slice"))
    # A given number of partitions is not put together again for being small ahead of the join.
    return dealt.repartition(tasks, *place).join(met.repartition(tasks, *place), place).select(*keys, *links.columns)


def same_site_links(
    links: DataFrame,
    seeds: DataFrame,
    keys: list[str],
    link: str = "link",
    seed: str = "seed_url",
    max_length: int = MAX_URL_LENGTH,
) -> DataFrame:
    """Links of bounded length whose host ends with a seed's host, per key.

    With ``keys=['lid_label']`` any seed of the label will do; with the seed's
    id as key each seed admits only its own links.
    """
    short = links.filter(F.length(link) <= max_length).withColumn("__host", urls.netloc(link))
    seed_hosts = seeds.select(*keys, urls.netloc(seed).alias("__seed_host"))
    fitting = same_site_hosts(short, seed_hosts, keys, "__host", "__seed_host")
    return short.join(fitting, [*keys, "__host"], "left_semi").select(*links.columns)

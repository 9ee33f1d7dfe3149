"""Registered queries of the operators in this folder, each with its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from linkloom.functions.local import work_out
from linkloom.llm import (
    alignment,
    archives,
    chat,
    conversation_repair,
    exact_dedup,
    external_shuffle,
    language_model,
    mixing,
    multi_index,
    near_dedup,
    packing,
    pii,
    sentence_pieces,
)
from linkloom.session import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op9_exact_dedup",
    """
    WITH d AS (
      SELECT doc_id, length(coalesce(text, '')) AS chars,
        sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
      FROM documents)
    SELECT doc_id,
      first_value(doc_id) OVER w AS keep_id,
      count(*) OVER (PARTITION BY text_sha256) AS group_size,
      row_number() OVER w = 1 AS kept,
      text_sha256
    FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST)
    """,
)
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op4_external_shuffle")
def op4_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written and read back; a test holds it against brute force, as the order is Spark's random numbers."""
    written = external_shuffle.write_shards(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return written.select(
        "row.doc_id",
        external_shuffle.record_size(F.col("row.text")).alias("size"),
        F.crc32(F.coalesce("row.text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# A conversation whose texts are made of control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


@query(
    "op2_prefix_targets",
    rf"""
    WITH rows_ AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL VALUES (-7, 0, 'user', '{CONTROL_TEXT}'), (-7, 1, 'assistant', '{CONTROL_TEXT}')),
    sized AS (
      SELECT *,
        22 + length(regexp_replace(role, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g'))
          + length(regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g')) AS size,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
        count(*) OVER (PARTITION BY conv_id) AS n
      FROM rows_),
    summed AS (
      SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS upto FROM sized)
    SELECT conv_id,
      count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
      coalesce(CAST(sum(length(text)) FILTER (role = 'assistant') AS BIGINT), 0) AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
      CAST(sum(upto) FILTER (role = 'assistant' OR place = n) AS BIGINT) AS formatted_chars
    FROM summed GROUP BY conv_id
    """,
)
def op2_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    examples = chat.expand_prefixes(given.unionByName(control))
    loss = F.when(
        F.col("target_turn").isNotNull(),
        F.struct("target_turn", chat.read_loss(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("text")),
    )
    read = examples.groupBy("conv_id").agg(
        F.max(F.when(F.col("last"), F.col("text"))).alias("whole"),
        F.sort_array(F.collect_list(loss)).alias("losses"),
        F.sum(F.length("text")).alias("formatted_chars"),
    )
    spoken = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (
        read.withColumn("turns", chat.read_turns(F.col("whole")))
        .withColumn("loss", F.array_join(F.transform("losses", lambda x: x["text"]), ""))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(spoken, ""), 256).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )


# Parameters of the mixture, shared with its twin.
MIX = {"entropy": 0.985, "max_repeats": 3.0, "block_tokens": 1 << 16, "seed": 17}


@query(
    "op7_temperature_mixing",
    rf"""
    WITH d AS (
      SELECT doc_id, source,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS tokens FROM documents),
    s AS (SELECT source, sum(tokens)::BIGINT AS total FROM d GROUP BY source),
    t AS (SELECT sum(total)::BIGINT AS t, count(*) FILTER (total > 0) AS n FROM s),
    p AS (SELECT source, total, total / t AS share FROM s, t WHERE total > 0),
    least_share AS (SELECT min(share) AS least FROM p),
    coarse AS (SELECT unnest(range(0, 1025)) * 1024 AS j),
    judged AS (
      SELECT j, ln(sum(pow(share, j / 1048576))) - j / 1048576 * sum(pow(share, j / 1048576) * ln(share))
          / sum(pow(share, j / 1048576)) AS bits, sum(pow(share, j / 1048576)) AS z
      FROM p, coarse GROUP BY j),
    first_ AS (
      SELECT coalesce(min(j), 1048576) AS j FROM judged, t, least_share
      WHERE bits <= {MIX["entropy"]} * ln(n) + 1e-12
        AND pow(least, j / 1048576 - 1) / z <= {MIX["max_repeats"]} + 1e-12),
    fine AS (SELECT unnest(range(greatest(j - 1024, 0), j + 1)) AS j FROM first_),
    judged2 AS (
      SELECT j, ln(sum(pow(share, j / 1048576))) - j / 1048576 * sum(pow(share, j / 1048576) * ln(share))
          / sum(pow(share, j / 1048576)) AS bits, sum(pow(share, j / 1048576)) AS z
      FROM p, fine GROUP BY j),
    found AS (
      SELECT coalesce(min(j), 1048576) AS j FROM judged2, t, least_share
      WHERE bits <= {MIX["entropy"]} * ln(n) + 1e-12
        AND pow(least, j / 1048576 - 1) / z <= {MIX["max_repeats"]} + 1e-12),
    q AS (
      SELECT p.source, total, t,
        CAST(floor(pow(share, found.j / 1048576) / z * t) AS BIGINT) AS quota,
        greatest((t + {MIX["block_tokens"] - 1}) // {MIX["block_tokens"]}, 1) AS blocks
      FROM p, t, found JOIN judged2 USING (j)),
    e AS (
      SELECT doc_id, d.source, tokens, coalesce(quota, 0) AS quota, coalesce(total, 0) AS total, blocks,
        unnest(range(0, CAST(greatest(coalesce(ceil(quota / total), 1), 1) AS BIGINT))) AS pass
      FROM d LEFT JOIN q ON d.source IS NOT DISTINCT FROM q.source),
    a AS (
      SELECT *, CAST(pass * total + coalesce(sum(tokens) OVER (PARTITION BY source, pass
          ORDER BY md5('{MIX["seed"]}:' || pass || ':' || coalesce(CAST(doc_id AS VARCHAR), '')),
            doc_id NULLS FIRST, tokens
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS pos
      FROM e),
    b AS (
      SELECT doc_id, source, tokens, quota, pass,
        CASE WHEN total > 0 THEN least(CAST(pos::HUGEINT * blocks // quota AS BIGINT), blocks - 1) ELSE 0 END AS block
      FROM a WHERE total = 0 OR pos < quota OR (tokens = 0 AND pos <= quota))
    SELECT *, row_number() OVER (PARTITION BY block
      ORDER BY md5('{MIX["seed"]}b:' || pass || ':' || coalesce(CAST(doc_id AS VARCHAR), '')),
        doc_id NULLS FIRST, source NULLS FIRST, tokens) - 1 AS slot
    FROM b
    """,
)
def op7_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The budget is the corpus's own number of tokens."""
    docs = table(spark, sf_dir, "documents")
    taken = mixing.mix(docs, budget=mixing.ALL, carry=False, **MIX)
    return mixing.with_slots(taken, MIX["seed"]).withColumnRenamed("id", "doc_id")


@query("op10_ppm_language_id")
def op10_ppm_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A test holds the costs against a byte-by-byte coder and measures held-out accuracy."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_model.train(docs.where(~language_model.held_out(docs["doc_id"])))
    return language_model.predict(docs.select("doc_id", "text"), model).select(
        "row.doc_id",
        language_model.held_out(F.col("row.doc_id")).alias("held_out"),
        "lang_pred",
        "score",
        "bits_per_byte",
    )


@query("op3_fast_similarity")
def op3_fast_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A test holds it against all pairs of sets."""
    groups = near_dedup.near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def tokenizer_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


@query("op8_best_fit_packing")
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tests hold the ids against the tokenizer and the plan against piece-by-piece best fit."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op6_arc_to_warc")
def op6_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as legacy archives, converted, and the WARC files read back; a test works the digests out anew."""
    legacy = archives.write_arcs(table(spark, sf_dir, "pages"))
    records = stored(archives.read_warcs(spark, archives.convert_arcs(spark, legacy)), "records")
    return archives.with_responses(records).select(
        F.col("key").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
        "target_uri",
        "date",
    )


@query("op5_weak_supervision")
def op5_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A test holds the base spans against the plain patterns; the models have no SQL form."""
    found = pii.find_spans(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col("id").alias("doc_id"),
        *[count(kind).alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )


@query("op1_multi_index")
def op1_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A test measures recall against all rows."""
    return multi_index.search(table(spark, sf_dir, "embeddings"))


def sql_repair() -> str:
    """The least edits by recursion from each conversation's last row, with whole strings for the four states."""
    blank, ended = "regexp_matches(text, '[^\\x20\\x09-\\x0D]')", "regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$')"
    none = "NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR[])"

    def after(state: str, cost: str, letter: str, line: str | None) -> str:
        lines = f"list_concat([{line}], {state}.t)" if line else f"{state}.t"
        return f"{{'c': {state}.c + {cost}, 'a': '{letter}' || {state}.a, 't': {lines}}}"

    def kept(state: int) -> str:
        goes = {0: "WHEN 's' THEN v1 WHEN 'u' THEN v2", 1: "WHEN 'u' THEN v2", 2: "WHEN 'a' THEN v3", 3: "WHEN 'u' THEN v2"}[state]
        # A role that cannot stay has no next state: null is left out of the least.
        return f"(CASE left(role, 1) {goes} END)"

    def taken(state: int) -> str:
        role, to = ("assistant", "v3") if state == 2 else ("user", "v2")
        keep = f"CASE WHEN fault IN (1, 2) OR {kept(state)} IS NULL THEN {none} ELSE " + after(kept(state), "extra", "K", "role || ':' || text") + " END"
        rerole = f"CASE WHEN fault IN (1, 2) THEN {none} ELSE " + after(to, "extra + 3", "R", f"'{role}:' || text") + " END"
        return f"list_min([{after(f'v{state}', '4', 'D', None)}, {keep}, {rerole}])"

    def added(name: str, other: str, role: str) -> str:
        return f"list_min([{name}, {after(other, '3', 'I', f"'{role}:'")}])"

    return f"""
    WITH RECURSIVE keyed AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
    hashed AS (
      SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(1, length(k) + 1),
          lambda i: list_concat([ord(k[i])::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
        lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END),
        4294967295::BIGINT) % 20 AS kind FROM keyed),
    harmed AS (
      SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
      FROM hashed WHERE kind <> 0),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS place,
        count(*) OVER (PARTITION BY conv_id) AS n,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
      FROM harmed),
    judged AS (
      SELECT *, CASE WHEN NOT {blank} THEN 1 WHEN nth > 1 THEN 2 WHEN NOT {ended} THEN 3 ELSE 0 END AS fault,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) || left(role, 1) AS met
      FROM placed),
    costed AS (SELECT *, CASE fault WHEN 3 THEN 3 ELSE 0 END AS extra FROM judged),
    states(conv_id, place, v0, v1, v2, v3) AS (
      SELECT conv_id, n + 1, {{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}}, {{'c': 6::BIGINT, 'a': 'II', 't': ['user:', 'assistant:']}},
        {{'c': 3::BIGINT, 'a': 'I', 't': ['assistant:']}}, {{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}}
      FROM costed WHERE place = n
      UNION ALL
      SELECT conv_id, place, {added("c0", "w2", "user")}, {added("c1", "w2", "user")}, w2, {added("c3", "w2", "user")}
      FROM (
        SELECT *, {added("c2", "c3", "assistant")} AS w2 FROM (
          SELECT r.conv_id, r.place, {taken(0)} AS c0, {taken(1)} AS c1, {taken(2)} AS c2, {taken(3)} AS c3
          FROM states s JOIN costed r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.place = s.place - 1))),
    counted AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
        count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
        count(*) FILTER (met NOT IN ('su', 'ua', 'au')) AS illegal
      FROM judged GROUP BY conv_id)
    SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
      coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(v0.c, 0) AS cost, coalesce(v0.a, '') AS audit,
      sha256(coalesce(array_to_string(v0.t, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) i
    LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM i.conv_id
    LEFT JOIN states s ON s.conv_id IS NOT DISTINCT FROM i.conv_id AND s.place = 1
    """


@query("op11_conversation_repair", sql_repair())
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = conversation_repair.audit(conversation_repair.damage(given)).withColumnRenamed("conv_id", "found_id")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in conversation_repair.FIGURES]
    return (
        given.select("conv_id")
        .distinct()
        .join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
        .select(
            "conv_id",
            *zero,
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )


@query("op12_tokenizer_alignment")
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A test works the groups, links and counts out with plain Python from the tokenizers' own output."""
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    made = alignment.align(table(spark, sf_dir, "documents"), *paths, digest=True)
    return made.withColumnRenamed("groups", "groups_sha256")


@query("op13_sentence_pieces")
def op13_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tests hold ids and texts against the library's own."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    made = work_out(docs, "made", sentence_pieces.round_trip(F.col("text"), path))
    return made.select(
        "doc_id",
        F.size("made.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("made.ids", ","), 256).alias("ids_sha256"),
        F.sha2("made.text", 256).alias("decoded_sha256"),
    )

"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: the text of all turns up to it, with
the loss on that reply alone. A conversation that does not end on an assistant turn
gives one example more, without loss, so that no turn is lost.

A turn is written as ``<s>[INST] role [/INST]text</s>``. A control string inside a
role or a text gets a backslash after its bracket, one more than it has already; taking
one away again restores the original, so escaping is reversible for any text.

Only DataFrame functions are used. A conversation is gathered into one value, as each of
its examples is one; the number of conversations is unbounded.

Defined cases: null roles and texts count as empty; a null conversation id is a
conversation of its own; turns with equal numbers are ordered by role, then text, nulls of the
number first; repeated rows are turns; an empty table gives an empty result; further columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, MIDDLE, CLOSE = "<s>[INST] ", " [/INST]", "</s>"

# A control string with any number of backslashes after its bracket.
CONTROL = r"([<\[])(\\*)(/?(?:s>|INST\]))"
ESCAPED = r"([<\[])\\(\\*)(/?(?:s>|INST\]))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(MIDDLE))


def expand_prefixes(turns: DataFrame, id: str = "conv_id") -> DataFrame:
    """Examples: ``conv_id``, ``example`` (from 0), ``target_turn`` (place of the reply, or null),
    ``text``, ``loss_start``, ``loss_end`` (code points, end exclusive) and ``last``."""
    rows = turns.select(
        turns[id].alias("conv_id"),
        F.struct(
            turns["turn"].alias("turn"),
            F.coalesce(turns["role"], F.lit("")).alias("role"),
            F.coalesce(turns["text"], F.lit("")).alias("text"),
        ).alias("turn"),
    )
    conversations = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    written = conversations.select(
        "conv_id",
        F.transform("turns", lambda t: t["role"]).alias("roles"),
        F.transform(
            "turns",
            lambda t: F.struct(escape(t["role"]).alias("role"), escape(t["text"]).alias("text")),
        ).alias("turns"),
    ).select(
        "conv_id",
        "roles",
        F.transform("turns", lambda t: F.concat(_head(t), t["text"], F.lit(CLOSE))).alias("parts"),
        F.transform("turns", lambda t: F.length(_head(t))).alias("heads"),
    )
    size = F.size("roles")
    targets = F.filter(
        F.sequence(F.lit(0), size - 1),
        lambda i: (F.get("roles", i) == "assistant") | (i == size - 1),
    )
    examples = written.select(
        "conv_id", "roles", "parts", "heads", F.posexplode(targets).alias("example", "at")
    )
    before = F.array_join(F.slice("parts", F.lit(1), F.col("at")), "")
    reply = F.get("roles", F.col("at")) == "assistant"
    start = F.length("before") + F.get("heads", F.col("at"))
    end = F.length("text") - len(CLOSE)
    return (
        examples.withColumn("before", before)
        .withColumn("text", F.concat("before", F.get("parts", F.col("at"))))
        .select(
            "conv_id",
            "example",
            F.when(reply, F.col("at")).alias("target_turn"),
            "text",
            F.when(reply, start).otherwise(F.length("text")).alias("loss_start"),
            F.when(reply, end).otherwise(F.length("text")).alias("loss_end"),
            (F.col("at") == size - 1).alias("last"),
        )
    )


def read_turns(text: Column) -> Column:
    """The turns of a formatted text: an array of (role, text), unescaped."""
    parts = F.filter(F.split(text, CLOSE), lambda p: p != "")

    def turn(part: Column) -> Column:
        return F.struct(
            unescape(F.substr(F.substring_index(part, MIDDLE, 1), F.lit(len(OPEN) + 1))).alias("role"),
            unescape(F.substr(part, F.instr(part, MIDDLE) + len(MIDDLE))).alias("text"),
        )

    return F.transform(parts, turn)


def read_loss(text: Column, start: Column, end: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return unescape(F.substr(text, start + 1, end - start))

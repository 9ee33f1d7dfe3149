"""Search dumps of any size: one JSON object of lists of results, read in many tasks.

A dump is split at every closing brace, wherever that is, so the reader can start at any byte of a file. Whether a piece begins inside a
string, and how deep, follows from running totals over the pieces before it; pieces are then
put together to results, each on its own. No object is ever one value but a single result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linkloom.operators.ordering import running_total, with_line_numbers
from linkloom.session import stored
from linkloom.sources.seeds import RESULT

# Stand for an escaped backslash and an escaped quote; bare control characters cannot be in JSON.
_BACKSLASH, _QUOTE = "\x01", "\x02"
# Depth of a list of results: root object, then the list under a key.
_LIST = 2


def _masked(text: Column) -> Column:
    """Without escaped quotes, so that every quote left opens or closes a string."""
    return F.replace(F.replace(text, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))


def _restored(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(_BACKSLASH), F.lit("\\\\")), F.lit(_QUOTE), F.lit('\\"'))


def _outside(segments: Column, inside_first: int) -> Column:
    """What is outside of strings, where a piece starts inside of one or not."""
    return F.array_join(F.filter(segments, lambda s, i: (i + inside_first) % 2 == 0), " ")


def _pair(high: Column, low: Column) -> Column:
    """Two counts in one number, to be run up together; both sums stay below 2^31 and neither below zero."""
    return (high * (1 << 32) + low).cast("bigint")


def _high(pair: str) -> Column:
    return F.shiftright(pair, 32).cast("int")


def _low(pair: str) -> Column:
    return F.col(pair).bitwiseAND(F.lit((1 << 32) - 1)).cast("int")


def _depth_change(outside: Column, ends_inside: Column) -> Column:
    """Objects and lists opened, less those closed."""
    number = lambda pattern: F.length(F.regexp_replace(outside, pattern, "")).cast("bigint")
    # The brace that ends the piece counts unless it is part of a string.
    return _pair(number(r"[^{]") - F.when(ends_inside, 0).otherwise(1), number(r"[^\[]") - number(r"[^\]]"))


def _first_open(segments: Column) -> Column:
    """1-based place of the first segment outside of strings with a brace, 0 without."""
    return F.array_position(F.transform(segments, lambda s, i: (i % 2 == 0) & F.contains(s, F.lit("{"))), True).cast("int")


def _without_root(text: Column) -> Column:
    return F.regexp_replace(text, r"^[^{]*\{", "")


def _opening(text: Column) -> Column:
    """Of a piece that starts outside of strings and at most in a list: the key of the list that is open before its first object, and the start of that object.

    ``at`` is the key's segment, null where the piece opens no list that stays open.
    """
    segments = F.split(text, '"')
    place = _first_open(segments)
    last = F.when(place > 0, place).otherwise(F.size(segments)) - 1
    before_object = lambda s: F.regexp_extract(s, r"^[^{]*", 0)
    at = F.array_max(
        F.transform(segments, lambda s, i: F.when((i % 2 == 0) & (i <= last) & before_object(s).rlike(r"^\s*:\s*\[[^\]]*$"), i - 1))
    )
    rest = F.array_join(F.slice(segments, F.greatest(place, F.lit(1)), F.size(segments)), '"')
    return F.struct(at.alias("at"), F.get(segments, at).alias("key"), _without_root(rest).alias("start"))


def _quoted(text: Column | str) -> Column:
    """A piece that starts inside a string, so that it starts outside."""
    return F.concat(F.lit('"'), text)


def _key(text: Column, broken: int = -1) -> Column:
    """The key of a piece; that in segment ``broken`` is not a whole one."""
    found = _opening(text)
    return F.struct(found["at"].isNotNull().alias("keyed"), F.when(found["at"] != broken, found["key"]).alias("key"))


def read_split_dump(spark: SparkSession, path: str) -> DataFrame:
    """(iso_code, pos, snippet, title, link, ...) of dump files, each one JSON object, or several one after the other.

    The rows of ``seeds.read_search_dump``. ``pos`` counts the objects of a list; anything else in a list, and values that
    are no lists, have no row. A key that comes twice keeps both lists; one with a closing brace in it is no code, and its list
    is left out. Of a file that breaks off, the results before are given.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select("value", "_metadata")
    numbered = with_line_numbers(pieces).select(F.col("_metadata.file_path").alias("file"), "line_no", _masked(F.col("value")).alias("text"))
    segments = F.split("text", '"')
    odd = (F.size(segments) - 1) % 2
    said = stored(
        numbered.select(
            "file",
            "line_no",
            "text",
            (F.size(segments) - 1).cast("bigint").alias("quotes"),
            _depth_change(_outside(segments, 0), odd == 1).alias("change_out"),
            _depth_change(_outside(segments, 1), odd == 0).alias("change_in"),
            _key(F.col("text")).alias("key_out"),
            # The rest of a string that began in another piece is not a whole key.
            _key(_quoted("text"), 1).alias("key_in"),
            # A piece that opens an object of the file leaves that brace out.
            _key(_without_root(F.col("text"))).alias("key_root"),
        ),
        "pieces",
    )
    # Numbers alone are run up; the text meets them by the number of its piece.
    counted = running_total(said.drop("text"), ["file"], "line_no", F.col("quotes"), "upto")
    inside = (F.col("upto") - F.col("quotes")) % 2 == 1
    stated = counted.select(
        "file", "line_no", "key_out", "key_in", "key_root", inside.alias("inside"), (F.col("upto") % 2 == 1).alias("ended_inside"),
        F.when(inside, F.col("change_in")).otherwise(F.col("change_out")).alias("change"),
    )
    deep = running_total(stated, ["file"], "line_no", F.col("change"), "depth").withColumn("before", F.col("depth") - F.col("change"))
    from_depth, to_depth = _high("before") + _low("before"), _high("depth") + _low("depth")
    # A result is closed where its list, under a key of the file's object, is left.
    closes = ~F.col("ended_inside") & (_high("depth") == 1) & (_low("depth") == 1)
    # The first piece of a result starts in the list, or further out.
    opens = (from_depth <= _LIST) & (to_depth + F.when(F.col("ended_inside"), 0).otherwise(1) > _LIST)
    root = from_depth == 0
    key = F.when(root, F.col("key_root")).when(F.col("inside"), F.col("key_in")).otherwise(F.col("key_out"))
    flagged = deep.select(
        "file", "line_no", "inside", root.alias("root"), closes.alias("closes"), opens.alias("opens"), (from_depth > _LIST).alias("within"),
        ((from_depth <= _LIST) & key["keyed"]).alias("keyed"), key["key"].alias("key"),
    )
    results = running_total(flagged, ["file"], "line_no", F.col("closes").cast("bigint"), "closed")
    places = running_total(results, ["file"], "line_no", _pair(F.col("keyed").cast("bigint"), F.col("opens").cast("bigint")), "places")
    # A result's number is that of the results closed before it.
    number = F.col("closed") - F.col("closes").cast("bigint")
    placed = stored(
        places.filter("opens or within or keyed").select(
            "file", "line_no", "inside", "root", "opens", "within", "closes", "keyed", "key", number.alias("result"),
            _high("places").alias("key_no"), _low("places").alias("object"),
        ),
        "placed",
    )
    named = placed.filter("keyed and key is not null").select(
        F.col("file").alias("of_file"), F.col("key_no").alias("of_key"), _unescaped(F.col("key")).alias("iso_code"), F.col("result").alias("first")
    )
    start = F.when(F.col("root"), _without_root(F.col("text"))).when(F.col("inside"), _quoted("text")).otherwise(F.col("text"))
    part = F.when(F.col("opens"), _opening(start)["start"]).otherwise(F.col("text"))
    parts = said.select("line_no", "text").join(placed.filter("opens or within"), "line_no")
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", part.alias("part")))), lambda x: x["part"]), "}")
    objects = (
        parts.groupBy("file", "object")
        .agg(whole.alias("body"), F.max("key_no").alias("key_no"), F.max(F.when(F.col("closes"), F.col("result"))).alias("result"))
        .filter("result is not null")
        .select("file", "result", "key_no", F.from_json(_restored(F.concat(F.lit("{"), "body", F.lit("}"))), RESULT).alias("r"))
    )
    same = (F.col("file") == F.col("of_file")) & (F.col("key_no") == F.col("of_key"))
    return objects.join(named, same).select("iso_code", (F.col("result") - F.col("first")).cast("int").alias("pos"), "r.*")


def _unescaped(key: Column) -> Column:
    return F.get(F.from_json(F.concat(F.lit('["'), _restored(key), F.lit('"]')), "array<string>"), F.lit(0))

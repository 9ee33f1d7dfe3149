"""HTML expressions over a column of page sources.

Tags, texts and attributes come from one linear pass over a source (``markup``), in Arrow batches; what is made of
them is Spark's: references (all numeric ones, all named ones of the standard), white space, the choice of blocks.
"""

from __future__ import annotations

import html.entities
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.pandas.types import from_arrow_type

from linkloom.functions import markup
from linkloom.functions.local import bind, text_slices
from linkloom.functions.text import WS, collapse_whitespace, strip

# A block goes when more than this part of its characters is in links; one of fewer characters than ``SHORT`` goes between two such.
MOST_LINKED = 0.5
SHORT = 25
# Bytes of page sources read at a time.
SLICE = 1 << 20

# Named entities of the standard, from the standard library's table, with ``;`` where one is needed.
_NAMED = json.dumps({name: text for name, text in html.entities.html5.items() if name.endswith(";")})
# Older names are known without ``;`` as well, the longest that fits.
_BARE = sorted((name for name in html.entities.html5 if not name.endswith(";")), key=lambda n: (-len(n), n))
_BARE_RE = f"^({'|'.join(_BARE)})"
_BARE_TEXT = json.dumps({name: html.entities.html5[name] for name in _BARE})


def _numbered() -> dict[str, str]:
    """Numbers that do not stand for the character of that number: Windows' extra range, and null."""
    out = {"0": "\ufffd", "13": "\r"}
    for n in range(0x80, 0xA0):
        byte = bytes([n])
        try:
            out[str(n)] = byte.decode("cp1252")
        except UnicodeDecodeError:
            out[str(n)] = chr(n)
    return out


_NUMBERED = json.dumps(_numbered())


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _table(text: str) -> Column:
    return F.from_json(F.lit(text), "map<string,string>")


def _character(n: Column) -> Column:
    """The character of a number; nothing for one that is none."""
    wide = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    unfit = ((n >= 0xD800) & (n <= 0xDFFF)) | (n > 0x10FFFF)
    control = (n < 0x20) & ~n.isin(9, 10, 12, 13)
    nothing = control | (n == 0x7F) | ((n >= 0xFDD0) & (n <= 0xFDEF)) | (F.pmod(n, F.lit(0x10000)) >= 0xFFFE)
    return (
        F.when(F.array_contains(F.map_keys(_table(_NUMBERED)), n.cast("string")), F.try_element_at(_table(_NUMBERED), n.cast("string")))
        .when(unfit, F.lit("\ufffd"))
        .when(nothing, F.lit(""))
        .otherwise(wide)
    )


def _reference(piece: Column, bare: bool) -> Column:
    """What follows an ampersand, with the reference at its start decoded; without ``;`` only where ``bare`` says so."""
    stop = ";?" if bare else ";"

    def numeric(digits: Column, base: int, start: Column) -> Column:
        # Eight digits or more are beyond any character.
        short = F.regexp_replace(digits, "^0+(?=.)", "")
        number = F.when(F.length(short) > 8, F.lit(0x110000)).otherwise(F.conv(short, base, 10).cast("bigint"))
        return F.concat(bind(number, _character), F.substr(piece, F.length(start) + 1))

    def decoded(m: Column) -> Column:
        return (
            F.when(m["tens"] != "", numeric(m["tens"], 10, m["number"]))
            .when(m["sixteens"] != "", numeric(m["sixteens"], 16, m["number"]))
            .when(m["known"].isNotNull(), F.concat(m["known"], F.substr(piece, F.length(m["name"]) + 1)))
            .when(F.lit(bare) & (m["bare"] != ""), F.concat(F.try_element_at(_table(_BARE_TEXT), m["bare"]), F.substr(piece, F.length(m["bare"]) + 1)))
            .otherwise(F.concat(F.lit("&"), piece))
        )

    name = F.regexp_extract(piece, r"^[a-zA-Z][a-zA-Z0-9]{0,31};", 0)
    return bind(
        F.struct(
            F.regexp_extract(piece, f"^#([0-9]+){stop}", 1).alias("tens"),
            F.regexp_extract(piece, f"^#[xX]([0-9a-fA-F]+){stop}", 1).alias("sixteens"),
            F.regexp_extract(piece, f"^#(?:[0-9]+|[xX][0-9a-fA-F]+){stop}", 0).alias("number"),
            name.alias("name"),
            F.when(name != "", F.try_element_at(_table(_NAMED), name)).alias("known"),
            (F.regexp_extract(piece, _BARE_RE, 1) if bare else F.lit("")).alias("bare"),
        ),
        decoded,
    )


def unescape(text: Column | str, bare: bool = True) -> Column:
    """Character references decoded, as a browser does; without ``bare`` those that no ``;`` ends stay as written."""

    def decode(held: Column) -> Column:
        pieces = F.split(held, "&")
        rest = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), lambda piece: _reference(piece, bare))
        return F.when(F.contains(held, F.lit("&")), F.concat(F.get(pieces, F.lit(0)), F.array_join(rest, ""))).otherwise(held)

    return bind(_c(text), decode)


def _per_page(read: Callable[[str], object], kind: pa.DataType) -> Callable[[Column | str], Column]:
    """A column function that reads each page source once, in Arrow batches."""

    def pages(sources: pa.Array) -> pa.Array:
        return pa.array((None if s is None else read(s) for s in map(pa.StringScalar.as_py, sources)), type=kind)

    pages.__annotations__ = {"sources": pa.Array, "return": pa.Array}
    return lambda source: F.arrow_udf(pages, from_arrow_type(kind))(_c(source))


def _visible_slices(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The visible text of page sources, ``SLICE`` bytes of them at a time: neither all sources of a batch nor all texts are held beside it."""
    for sources in batches:
        for held in text_slices(sources, SLICE):
            yield pa.array([None if s is None else markup.visible(s) for s in held], type=_TEXT)


# Not for functions that are used side by side: those share a worker as they are.
_visible_slices.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}


def _visible(source: Column | str) -> Column:
    return F.arrow_udf(_visible_slices, "string")(_c(source))


_TEXT = pa.string()
_blocks = _per_page(markup.blocks, pa.list_(pa.struct([("text", _TEXT), ("chars", pa.int32()), ("linked", pa.int32())])))
_hrefs = _per_page(markup.hrefs, pa.list_(_TEXT))
_metadata = _per_page(markup.metadata, pa.struct([(name, _TEXT) for name in ("lang", "title", "description", "keywords")]))


def html_to_text(source: Column | str, bare: bool = True) -> Column:
    """Visible text with tags turned into blanks and whitespace collapsed."""
    return collapse_whitespace(unescape(_visible(source), bare))


def main_text(source: Column | str, bare: bool = True) -> Column:
    """Main content, one line per block: of ``<article>``, else of ``<body>``, without navigation, forms and the like and
    without blocks that are mostly links; null if empty."""

    def is_list(block: Column) -> Column:
        return F.coalesce(block["linked"] > MOST_LINKED * block["chars"], F.lit(False))

    def kept(found: Column) -> Column:
        def stays(block: Column, i: Column) -> Column:
            between = (i > 0) & is_list(F.get(found, i - 1)) & is_list(F.get(found, i + 1))
            return ~is_list(block) & ~((block["chars"] < SHORT) & between)

        return F.array_join(F.transform(F.filter(found, stays), lambda block: block["text"]), "\n")

    tidy = F.regexp_replace(unescape(bind(_blocks(source), kept), bare), rf"{WS}*\n{WS}*", "\n")
    return bind(strip(tidy), lambda t: F.nullif(t, F.lit("")))


def hrefs(source: Column | str) -> Column:
    """Link targets of a page, each once, as its source means them."""
    return F.array_distinct(F.transform(_hrefs(source), lambda href: unescape(href)))


def page_metadata(source: Column | str, headers: Column | None = None, bare: bool = True) -> Column:
    """Language, title, description and keywords of a page; null without ``<html>``."""
    header = F.try_element_at(headers, F.lit("Content-Language")) if headers is not None else F.lit(None).cast("string")

    def read(m: Column) -> Column:
        return F.when(
            m.isNotNull(),
            F.struct(
                F.nullif(m["lang"], F.lit("")).alias("content_language"),
                header.alias("content_language_header"),
                strip(unescape(m["title"], bare)).alias("title"),
                F.nullif(unescape(m["description"], bare), F.lit("")).alias("description"),
                F.nullif(unescape(m["keywords"], bare), F.lit("")).alias("keywords"),
            ),
        )

    return bind(_metadata(source), read)

"""Text expressions: whitespace, character tokens, truncation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Whitespace as Python's ``str`` methods see it, spelled so that Java and RE2 agree.
WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(text: Column | str) -> Column:
    return F.regexp_replace(_c(text), rf"^{WS}+|{WS}+$", "")


def collapse_whitespace(text: Column | str) -> Column:
    return strip(F.regexp_replace(_c(text), rf"{WS}+", " "))


def drop_newlines(text: Column | str) -> Column:
    """Remove line feeds before language identification; words across lines join."""
    return F.replace(_c(text), F.lit("\n"), F.lit(""))


def char_tokenize(text: Column | str) -> Column:
    """Characters joined by one blank; blanks of the text show as two blanks."""
    text = _c(text)
    spaced = F.array_join(F.split(text, ""), " ")
    return F.when(text.isNull(), F.lit(None).cast("string")).otherwise(
        strip(F.regexp_replace(spaced, rf"{WS}{{2,}}", "  "))
    )


def squeeze(text: Column | str) -> Column:
    """The text without any whitespace: its character tokens side by side."""
    return F.regexp_replace(_c(text), rf"{WS}+", "")


def char_ngrams(text: Column | str, n: int, shorter_at_end: bool = False) -> Column:
    """All runs of ``n`` characters, overlapping, in one linear pass over the text.

    With ``shorter_at_end`` a run starts at every character and the last ones are
    shorter. A match must not start inside a character beyond the basic plane.
    """
    size = f"1,{n}" if shorter_at_end else str(n)
    runs = rf"(?s)(?![\x{{DC00}}-\x{{DFFF}}])(?=(.{{{size}}}))"
    return F.regexp_extract_all(_c(text), F.lit(runs), F.lit(1))


def truncate(text: Column | str, length: Column | int) -> Column:
    return F.substring(_c(text), F.lit(1), F.lit(length) if isinstance(length, int) else length)

"""Text expressions: line splitting, the space tokenizer, string length."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line terminators of a Hadoop/Spark text source (\r\n, \r, \n).
LINE_BREAK = r"\r\n|\r|\n"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_final_break(text: Column | str) -> Column:
    """The text without one line terminator at its very end (cut by length,
    no regex scan); NULL for an empty text, which has no line at all."""
    t = _col(text)
    cut = F.when(t.endswith("\r\n"), 2).when(t.endswith("\n") | t.endswith("\r"), 1).otherwise(0)
    return F.when(t != "", F.substring(t, F.lit(1), F.length(t) - cut))


def split_body(body: Column | str) -> Column:
    """Lines of a ``strip_final_break`` result; every piece, empty ones
    included, is a line. A body without ``\\r`` is split on the single
    character ``\\n`` (Java's fast path) instead of the alternation."""
    b = _col(body)
    pieces = F.when(F.instr(b, "\r") == 0, F.split(b, "\n", -1)).otherwise(F.split(b, LINE_BREAK, -1))
    return F.when(b.isNull(), F.array().cast("array<string>")).otherwise(pieces)


def split_lines(text: Column | str) -> Column:
    """Lines of a text value, as a line-oriented file source would read them:
    a terminator at the very end does not open an empty last line, and an
    empty text has no line at all. In a generator, prefer projecting
    ``strip_final_break`` first and splitting that column with ``split_body``.
    """
    return split_body(strip_final_break(text))


def tokenize(line: Column | str) -> Column:
    """Split on a single space with the rules of Java's ``String.split(" ")``.

    Leading and inner empty tokens are kept, trailing empty tokens are
    dropped; ``""`` gives ``[""]`` and an all-space line gives ``[]``. Case
    and punctuation are kept. Spark's ``split`` keeps trailing empties, hence
    the ``rtrim`` (which strips spaces only).
    """
    s = _col(line)
    trimmed = F.rtrim(s)
    return (
        F.when(s == "", F.array(F.lit("")))
        .when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, " ", -1))
    )


def utf16_length(word: Column | str) -> Column:
    """Length in UTF-16 code units (``String.length()``), as BIGINT.

    Equals the code point count except for characters outside the BMP, which
    count twice.
    """
    return F.floor(F.octet_length(F.encode(_col(word), "UTF-16LE")) / F.lit(2)).cast("long")

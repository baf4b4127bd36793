"""Substring dedup: units of text are normalised and hashed, their digests are
grouped over the whole corpus, the earliest ranked occurrence stays, and the
others are removed by spans of the original text.

Units are lines and paragraphs (cut at blank lines) of ``LINE_WORDS`` words or
more, each taken whole. They do not find a passage that is set into another
paragraph, so paragraphs cut by content are units too. Words (A-Z lower-cased, punctuation out)
are winnowed: of every ``WINNOW`` words in sequence, the one with the lowest
hash begins a unit, as does the first word of a text. A unit runs over at least
``UNIT_WORDS`` words to where the next one begins, or to the end. Where units
begin depends on nearby words only, so two texts that share a passage of
``2 * WINNOW + UNIT_WORDS + 1`` words or more share a unit, wherever the passage
stands, and at most ``WINNOW`` words at either end of it are missed if it is no
whole line or paragraph.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import WordHashes, cut_spans, folded_words, map_arrow, mix, row_key, slices, texts
from quern.session import ScratchTables

WINNOW = 10
UNIT_WORDS = 16
LINE_WORDS = 3  # shorter lines (headings, answers) are no units
SLICE_BYTES = 8 << 20
_POSITION_BITS = np.uint64(26)  # of a slice's words, in the order that winnowing sees
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BREAK = re.compile(rb"[\r\n]")
_BLANK = re.compile(rb"(?:\n|\r(?!\n))[ \t\r]*(?:\n|\r(?!\n))")


def cuts(h: np.ndarray, left: np.ndarray, winnow: int) -> np.ndarray:
    """Where units begin. ``left``: words from here to the end of the text."""
    n = len(h)
    bits = _POSITION_BITS
    order = mix(h + np.uint64(1))
    order = (order >> bits) << bits
    x = order | (np.uint64((1 << int(bits)) - 1) - np.arange(n, dtype=np.uint64))  # of equal ones, the last
    low, width = x.copy(), 1
    while 2 * width <= winnow:
        low[: n - width] = np.minimum(low[: n - width], low[width:])
        width *= 2
    if width < winnow and n > winnow - width:
        low[: n - (winnow - width)] = np.minimum(low[: n - (winnow - width)], low[winnow - width :])
    chosen = low[left >= winnow]
    at = np.uint64((1 << int(bits)) - 1) - (chosen & np.uint64((1 << int(bits)) - 1))
    return np.unique(at.astype(np.int64))


def _sums(h: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of h[k] * base**k, and the powers of the inverse."""
    n = len(h)
    powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]))
    back = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, pow(base, -1, 1 << 64), np.uint64)]))
    return np.concatenate([[np.uint64(0)], np.add.accumulate(h * powers[:n])]), back


def lines(data: bytes, line_words: int) -> np.ndarray:
    """First word, word after the last, first byte and byte after the last of
    each line and of each paragraph of several lines, in that order in rows."""
    starts, _ = _edges(data)
    if len(starts) < line_words:
        return np.empty((0, 4), np.int64)
    breaks = np.array([-1, *(m.start() for m in _BREAK.finditer(data)), len(data)], np.int64)
    blanks = np.array([m.end() - 1 for m in _BLANK.finditer(data)], np.int64)
    line = np.searchsorted(breaks, starts) - 1
    new = np.concatenate([[True], line[1:] != line[:-1]])
    paragraph = np.searchsorted(blanks, starts)
    found = []
    for of in (new, np.concatenate([[True], paragraph[1:] != paragraph[:-1]])):
        a = np.flatnonzero(of)
        b = np.append(a[1:], len(starts))
        found.append(np.stack([a, b, breaks[line[a]] + 1, breaks[line[b - 1] + 1]], axis=1))
    own, more = found
    more = more[line[more[:, 0]] != line[more[:, 1] - 1]]
    out = np.concatenate([own, more])
    return out[out[:, 1] - out[:, 0] >= line_words]


def units(
    words: list[list[bytes]], hashes: WordHashes, winnow: int, unit_words: int, whole: list[np.ndarray] | None = None
) -> tuple[np.ndarray, ...]:
    """Of all units: document, first word, word after the last (counted within
    the document), two digests, and whether the document has had it before.
    ``whole``: each document's units (first word, word after the last) besides
    those cut by content."""
    sizes = np.array([len(w) for w in words], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    total = int(starts[-1])
    if not total:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2 + (np.empty(0, bool),)
    h = np.concatenate([hashes.array(w) for w in words])
    doc = np.repeat(np.arange(len(words)), sizes)
    left = starts[1:][doc] - np.arange(total)
    at = np.unique(np.concatenate([cuts(h, left, winnow), starts[:-1][sizes > 0]]))
    a = at[left[at] >= unit_words]
    after = np.searchsorted(at, a + unit_words)
    ends = starts[1:][doc[a]]
    b = np.minimum(np.append(at, total)[after], ends)
    if whole is not None:  # in order of place, each place once
        more = np.concatenate([x[:, :2] + n for x, n in zip(whole, starts[:-1], strict=True)])
        a, b = np.unique(np.concatenate([np.stack([a, b], axis=1), more]), axis=0).T
    digests = []
    for base in _BASES:
        sums, back = _sums(mix(h ^ np.uint64(base)), base)
        digests.append(mix((sums[b] - sums[a]) * back[a] + (b - a).astype(np.uint64)))
    key = mix(digests[0] ^ mix(doc[a].astype(np.uint64) + np.uint64(1)))
    first = np.zeros(len(a), bool)
    first[np.unique(key, return_index=True)[1]] = True
    return doc[a], a - starts[doc[a]], b - starts[doc[a]], *digests, ~first


def _edges(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bytes at which words begin, and after which they end."""
    raw = np.frombuffer(data.translate(_FOLD), np.uint8)
    solid = (raw >= 128) | ((raw >= 48) & (raw <= 57)) | ((raw >= 97) & (raw <= 122))
    edge = np.flatnonzero(np.diff(np.concatenate([[0], solid.view(np.int8), [0]])))
    return edge[::2], edge[1::2]


def _places(data: bytes, a: np.ndarray, b: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code point offsets of the units from word ``a`` to before word ``b``;
    whole lines and paragraphs with all that stands in them."""
    starts, ends = _edges(data)
    start, end = starts[a], ends[b - 1]
    if len(whole):
        n = len(starts) + 1
        whole = whole[np.argsort(whole[:, 0] * n + whole[:, 1], kind="stable")]
        keys, own = whole[:, 0] * n + whole[:, 1], a * n + b
        i = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        is_whole = keys[i] == own
        start, end = np.where(is_whole, whole[i, 2], start), np.where(is_whole, whole[i, 3], end)
    points = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
    return points[start], points[end]


def _units(winnow: int, unit_words: int, line_words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in slices(batches, "text", SLICE_BYTES):
        data = texts(batch.column("text"))
        words = [folded_words(x) for x in data]
        whole = [lines(x, line_words) for x in data]
        doc, a, b, d1, d2, again = units(words, hashes, winnow, unit_words, whole)
        start, end = np.empty(len(a), np.int64), np.empty(len(a), np.int64)
        edges = np.searchsorted(doc, np.arange(len(data) + 1))
        for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if lo < hi:
                start[lo:hi], end[lo:hi] = _places(data[i], a[lo:hi], b[lo:hi], whole[i])
        rows = pa.array(doc)
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c).take(rows) for c in ("r1", "r2", "doc_id")),
                pa.array(d1.view(np.int64)),
                pa.array(d2.view(np.int64)),
                pa.array(start.astype(np.int32)),
                pa.array(end.astype(np.int32)),
                pa.array(again),
            ],
            names=["r1", "r2", "doc_id", "d1", "d2", "start", "end", "again"],
        )


def units_of(docs: DataFrame, id_col: str, text_col: str, winnow: int, unit_words: int, line_words: int) -> DataFrame:
    """``r1, r2, doc_id, d1, d2, start, end, again`` of every unit."""
    inp = docs.select(
        *row_key(F.col(id_col), F.col(text_col)), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")
    )
    kind = inp.schema["doc_id"].dataType.simpleString()
    schema = f"r1 bigint, r2 bigint, doc_id {kind}, d1 bigint, d2 bigint, start int, end int, again boolean"
    return map_arrow(inp, lambda batches: _units(winnow, unit_words, line_words, batches), schema)


def _removed(docs: DataFrame, id_col: str, text_col: str, winnow: int, unit_words: int, line_words: int) -> DataFrame:
    """``r1, r2, doc_id, start, end, kept_doc_id`` of the merged spans."""
    found = units_of(docs, id_col, text_col, winnow, unit_words, line_words)
    # a digest costs a task one row, however often it occurs
    groups = found.groupBy("d1", "d2").agg(F.min("doc_id").alias("kept_doc_id"), F.count(F.lit(1)).alias("n"))
    # written out, so that both sides of the join come straight from an exchange and hot digests can be split
    twice = ScratchTables(docs.sparkSession, "substring-dedup").put(groups.where("n > 1").drop("n"), "digests")
    gone = (
        found.join(twice, ["d1", "d2"])
        .where("again OR (kept_doc_id IS NOT NULL AND (doc_id IS NULL OR doc_id > kept_doc_id))")
        .select("r1", "r2", "doc_id", "start", "end", "kept_doc_id")
        .distinct()  # of rows that repeat
    )
    row = Window.partitionBy("r1", "r2").orderBy("start", "end")  # one text's units
    before = row.rowsBetween(Window.unboundedPreceding, -1)
    return (
        gone.withColumn("new", F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True)).cast("int"))
        .withColumn("span", F.sum("new").over(row.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("r1", "r2", "span")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.min("kept_doc_id").alias("kept_doc_id"),
        )
        .drop("span")
    )


def spans(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    winnow: int = WINNOW,
    unit_words: int = UNIT_WORDS,
    line_words: int = LINE_WORDS,
) -> DataFrame:
    """``doc_id, start, end, kept_doc_id`` of every span to remove: code points
    of the original text, end exclusive, and the lowest id that keeps a unit
    of the span. A document with nothing to remove has no row.

    Occurrences rank by (doc_id, place in the text). Documents of one id rank
    alike; a null id comes last, and null ids do not remove from each other.
    Null and empty texts, and texts under ``line_words`` words, have no units.
    A whole line or paragraph goes with its punctuation, without its last break.
    Rows that repeat in id and text give their spans once.
    """
    return _removed(docs, id_col, text_col, winnow, unit_words, line_words).select("doc_id", "start", "end", "kept_doc_id")


def dedup(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    winnow: int = WINNOW,
    unit_words: int = UNIT_WORDS,
    line_words: int = LINE_WORDS,
) -> DataFrame:
    """``row`` (all columns of ``docs`` as a struct), ``text`` without the
    removed spans (each leaves one line break), and ``spans``, their offsets in
    the original text (empty if none)."""
    lists = (
        _removed(docs, id_col, text_col, winnow, unit_words, line_words)
        .groupBy("r1", "r2")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    )
    base = docs.select(
        *row_key(F.col(id_col), F.col(text_col)),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(text_col).alias("t"),
    )
    return base.join(lists, ["r1", "r2"], "left").select(
        "row",
        F.expr(f"if(spans IS NULL, t, {cut_spans('t', 'spans')})").alias("text"),
        F.expr("coalesce(spans, array())").cast("array<struct<start:int,end:int>>").alias("spans"),
    )

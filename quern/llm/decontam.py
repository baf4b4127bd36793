"""Benchmark decontamination by an FM-index over each shard of the corpus.

A shard is a run of documents of one task (up to ``shard_words`` words; one
longer document is a shard of its own). Its words are numbered by the
benchmark's vocabulary; a word that no phrase has ends a suffix, and a run of
such words is one separator. Over this sequence the task builds a suffix
array, the Burrows-Wheeler transform, a wavelet matrix with prefix ranks, and
suffix positions sampled every ``SAMPLE`` words. All phrases are then searched
backwards at once, their rows are located through the sampled positions, and
the occurrences merge into removal spans. Documents are never shuffled.

The phrases are the stated query set. They travel as broadcast blocks of about
``block_bytes`` of benchmark text and ``block_windows`` windows (both are summed
first). A larger benchmark takes more blocks, and every block is searched in
all documents: what a block hits is written, its broadcast destroyed, and the
next one built, so that only one block is held at a time; the hits of all
blocks then join the documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from quern.llm.common import FOLDED_WORD, cut_spans, folded_words, map_arrow, packed, slices, texts
from quern.session import ScratchTables

SAMPLE = 8
BLOCK_WINDOWS = 1 << 20
SALTS = 16
_WORD = re.compile(FOLDED_WORD.encode())
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


# ------------------------------------------------------------------ FM-index


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Suffixes of ``seq`` in order. 0 is a separator; each one counts as a
    symbol of its own, in order of position, below all words. The last symbol
    must be 0. Prefix doubling that sorts only groups that are still tied."""
    n = len(seq)
    seps = np.flatnonzero(seq == 0)
    key = seq.astype(np.int64) + len(seps)
    key[seps] = np.arange(len(seps))
    sa = np.argsort(key, kind="stable")
    first = np.empty(n, bool)
    first[0] = True
    np.not_equal(key[sa[1:]], key[sa[:-1]], out=first[1:])
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    tied = ~first
    tied[:-1] |= tied[1:]
    slots = np.flatnonzero(tied)
    h = 1
    while len(slots):
        act = sa[slots]
        key = rank[act] * n + rank[act + h]  # a tied prefix holds no separator, so act + h stays inside
        order = np.argsort(key, kind="stable")
        act, key = act[order], key[order]
        sa[slots] = act
        first = np.empty(len(key), bool)
        first[0] = True
        np.not_equal(key[1:], key[:-1], out=first[1:])
        rank[act] = np.maximum.accumulate(np.where(first, slots, 0))
        tied = ~first
        tied[:-1] |= tied[1:]
        slots = slots[tied]
        h *= 2
    return sa


class FMIndex:
    """Backward search and location over one word sequence (see
    ``suffix_array`` for its form); all operations take arrays."""

    def __init__(self, seq: np.ndarray, symbols: int):
        n = len(seq)
        sa = suffix_array(seq)
        bwt = seq[sa - 1]  # sa 0 wraps to the last symbol, a separator
        self.n = n
        self.below = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=symbols))[:-1]])
        self.bits = max(1, int(symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        x = bwt
        for bit in range(self.bits - 1, -1, -1):
            b = (x >> bit) & 1
            ones = np.zeros(n + 1, np.int32)
            np.cumsum(b, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(n - int(ones[n]))
            up = b.astype(bool)
            x = np.concatenate([x[~up], x[up]])
        self.bwt = bwt
        # sampled: every SAMPLE-th position and each one after a separator
        marked = (sa % SAMPLE == 0) | (bwt == 0)
        self.mark = np.zeros(n + 1, np.int32)
        np.cumsum(marked, out=self.mark[1:])
        self.sampled = sa[marked]

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level in range(self.bits):
            ones = self.ones[level][i]
            up = (c >> (self.bits - 1 - level)) & 1
            i = np.where(up == 1, self.zeros[level] + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``c`` is among the first ``i`` symbols of the transform."""
        return self._down(c, i) - self._down(c, np.zeros_like(i))

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges ``lo, hi`` of the phrases (one a row, equal lengths)."""
        k, length = phrases.shape
        lo, hi = np.zeros(k, np.int64), np.full(k, self.n, np.int64)
        live = np.arange(k)
        for t in range(length - 1, -1, -1):
            c = phrases[live, t]
            start = self._down(c, np.zeros(len(c), np.int64))
            lo[live] = self.below[c] + self._down(c, lo[live]) - start
            hi[live] = self.below[c] + self._down(c, hi[live]) - start
            dead = lo[live] >= hi[live]
            hi[live[dead]] = lo[live[dead]]
            live = live[~dead]
            if not len(live):
                break
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows of the suffix array."""
        out = np.empty(len(rows), np.int64)
        todo, row, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(todo):
            at = self.mark[row]
            hit = self.mark[row + 1] > at
            out[todo[hit]] = self.sampled[at[hit]] + steps
            todo, row = todo[~hit], row[~hit]
            c = self.bwt[row]
            row = self.below[c] + self.rank(c, row)
            steps += 1
        return out


# ------------------------------------------------------------------- phrases


@dataclass
class Phrases:
    """Distinct windows of a block of benchmark items over its vocabulary."""

    vocabulary: dict[bytes, int]
    windows: list[np.ndarray]  # one matrix for each length
    owners: list[tuple[np.ndarray, np.ndarray]]  # the items that have each window, one after the other, and where each window's begin
    names: list[str]


def phrases_of(rows: list[tuple[object, str | None]], window: int) -> Phrases:
    vocabulary: dict[bytes, int] = {}
    names: dict[str, int] = {}
    found: dict[int, list[tuple[int, np.ndarray]]] = {}  # by length: items and their words
    for name, text in rows:
        words = folded_words((text or "").encode())
        ids = np.fromiter((vocabulary.setdefault(w, len(vocabulary) + 1) for w in words), np.int32, len(words))
        item = names.setdefault("null" if name is None else str(name), len(names))
        if len(ids):
            found.setdefault(min(window, len(ids)), []).append((item, ids))
    windows, owners = [], []
    for size, texts_ in sorted(found.items()):
        every = np.concatenate([np.lib.stride_tricks.sliding_window_view(ids, size) for _, ids in texts_])
        of = np.repeat([item for item, _ in texts_], [len(ids) - size + 1 for _, ids in texts_])
        distinct, which = np.unique(every, axis=0, return_inverse=True)
        pairs = np.unique(np.stack([which.reshape(-1), of], axis=1), axis=0)
        windows.append(distinct)
        owners.append((pairs[:, 1].astype(np.int32), np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1))))
    return Phrases(vocabulary, windows, owners, list(names))


def search_shard(docs: list[list[bytes]], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
    """Over all words of the shard: which are hit; where each document starts
    (with the end at last); and each document's items."""
    starts = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
    total = int(starts[-1])
    hit, items = np.zeros(total, bool), [[] for _ in docs]
    if not total or not phrases.windows:
        return hit, starts, items
    get = phrases.vocabulary.get
    ids = np.fromiter((get(w, 0) for d in docs for w in d), np.int64, total)
    # a separator between documents; a run of unknown words or separators is one
    pos = np.arange(total) + np.repeat(np.arange(len(docs)), np.diff(starts))
    seq = np.zeros(total + len(docs), np.int64)
    seq[pos] = ids
    keep = np.ones(len(seq), bool)
    keep[1:] = (seq[1:] != 0) | (seq[:-1] != 0)
    origin = np.full(len(seq), -1, np.int64)
    origin[pos] = np.arange(total)
    seq, origin = seq[keep], origin[keep]
    if not seq.any():
        return hit, starts, items
    if seq[-1] != 0:
        seq, origin = np.append(seq, 0), np.append(origin, -1)
    index = FMIndex(seq, len(phrases.vocabulary) + 1)
    edge = np.zeros(total + 1, np.int64)
    pairs: set[tuple[int, int]] = set()
    for windows, (owners, begin) in zip(phrases.windows, phrases.owners, strict=True):
        lo, hi = index.search(windows)
        n = hi - lo
        which = np.repeat(np.arange(len(windows)), n)
        if not len(which):
            continue
        rows = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        at = origin[index.locate(rows)]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + windows.shape[1], -1)
        doc = np.searchsorted(starts, at, side="right") - 1
        for d, w in np.unique(np.stack([doc, which], 1), axis=0).tolist():
            pairs.update((d, item) for item in owners[begin[w] : begin[w + 1]].tolist())
    hit = np.cumsum(edge[:-1]) > 0
    for d, item in sorted(pairs):
        items[d].append(item)
    return hit, starts, items


def _ranges(hit: np.ndarray) -> list[tuple[int, int]]:
    """Runs of set entries as (start, end)."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def merge_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of ranges; touching or crossing ones become one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((start, end))
    return out


def _spans(data: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of words as spans of code points, the end exclusive; what lies
    between the words of a range belongs to its span."""
    starts, ends = {a for a, _ in ranges}, {b - 1 for _, b in ranges}
    at: list[int] = []
    for i, m in enumerate(_WORD.finditer(data.translate(_LOWER))):
        if i in starts:
            at.append(m.start())
        if i in ends:
            at.append(m.end())
    points, chars, last = [], 0, 0
    for x in at:
        chars += len(data[last:x].decode("utf-8", "replace"))
        last = x
        points.append(chars)
    return list(zip(points[::2], points[1::2], strict=True))


_PAIRS = "array<struct<start:int,end:int>>"
_SPAN = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))
_COLUMNS = {"n_words": LongType(), "hits": _SPAN, "items": ArrayType(StringType()), "spans": _SPAN}
_PAIR_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _pairs(column: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"start": a, "end": b} for a, b in x] for x in column], _PAIR_TYPE)


def _found(phrases: Phrases, data: list[bytes]) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[list[str]]]:
    """Words of each text, its ranges of hit words, and its items in order."""
    hit, starts, items = search_shard([folded_words(x) for x in data], phrases)
    hits = [_ranges(hit[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]
    return np.diff(starts), hits, [sorted(phrases.names[i] for i in x) for x in items]


def _search(shared, shard_bytes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All of a row's columns by one block."""
    for batch in slices(batches, "text", shard_bytes):
        data = texts(batch.column("text"))
        n_words, hits, names = _found(shared.value, data)
        spans = [_spans(x, r) if r else [] for x, r in zip(data, hits, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("text"), pa.array(n_words, pa.int64()), _pairs(hits), pa.array(names, pa.list_(pa.string())), _pairs(spans)],
            names=["row", "text", "n_words", "hits", "items", "spans"],
        )


def _search_block(shared, shard_bytes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What one of several blocks hits, of texts with a hit."""
    for batch in slices(batches, "text", shard_bytes):
        _, hits, names = _found(shared.value, texts(batch.column("text")))
        rows = pa.array([i for i, x in enumerate(hits) if x], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("r").take(rows), _pairs(hits).take(rows), pa.array(names, pa.list_(pa.string())).take(rows)],
            names=["r", "hits", "items"],
        )


def _merge(shard_bytes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All of a row's columns from the hits of several blocks."""
    for batch in slices(batches, "text", shard_bytes):
        data = texts(batch.column("text"))
        hits = [merge_ranges([(x["start"], x["end"]) for x in old or ()]) for old in batch.column("hits").to_pylist()]
        names = [sorted({*(x or ())}) for x in batch.column("items").to_pylist()]
        n_words = [len(folded_words(x)) for x in data]
        spans = [_spans(x, r) if r else [] for x, r in zip(data, hits, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("text"), pa.array(n_words, pa.int64()), _pairs(hits), pa.array(names, pa.list_(pa.string())), _pairs(spans)],
            names=["row", "text", "n_words", "hits", "items", "spans"],
        )


def blocks(
    benchmark: DataFrame, item_col: str, text_col: str, window: int, block_bytes: int, block_windows: int = BLOCK_WINDOWS
) -> tuple[int, Iterator[Phrases]]:
    """How many blocks the benchmark takes, and the phrases of each, one block
    at a time on the driver. Items go to blocks by a hash; one item that is
    larger than a block makes its block as large as itself."""
    rows = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).distinct()
    words = F.regexp_count(F.lower("text"), F.lit(FOLDED_WORD))  # an item has no more windows than words
    size, count = rows.agg(F.sum(F.octet_length("text")), F.sum(words)).first()
    n = max(1, -(-int(size or 0) // block_bytes), -(-int(count or 0) // block_windows))
    part = lambda b: rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b)
    return n, (phrases_of([tuple(r) for r in part(b).collect()], window) for b in range(n))


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    shard_bytes: int = 8 << 20,
    block_bytes: int = 8 << 20,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """``row`` (all columns of ``docs`` as a struct), ``text``, ``n_words``,
    ``hits``, ``items`` and ``spans`` for each row of ``docs``.

    A window is ``window`` consecutive item words; an item of fewer words, but
    not none, is one window. A word inside any occurrence is hit: ``hits`` are
    the ranges of hit words, ``spans`` the same in code points, ends exclusive.
    Null and empty texts have no words; an empty benchmark hits nothing; rows
    that repeat are handled each on its own; equal items count once; an item
    without id is named ``null``.
    """
    spark = docs.sparkSession
    context = spark.sparkContext
    row = packed(docs, text=F.col(text_col))
    done = StructType([*row.schema, *(StructField(c, t) for c, t in _COLUMNS.items())])
    n, parts = blocks(benchmark, item_col, item_text_col, window, block_bytes, block_windows)
    if n == 1:
        return map_arrow(row, partial(_search, context.broadcast(next(parts)), shard_bytes), done)
    tables = ScratchTables(spark, "decontamination")
    # a text, or null, that many rows have is joined in ``SALTS`` places, by what else the rows hold
    other = [F.col(f"row.`{f.name}`") for f in docs.schema if not re.search("map<|variant", f.dataType.simpleString())]
    keyed = row.select(
        "row", "text", F.unhex(F.sha2("text", 256)).alias("r"), F.pmod(F.xxhash64(*other), F.lit(SALTS)).cast("int").alias("cell")
    )
    found = []
    for phrases in parts:
        shared = context.broadcast(phrases)
        one = map_arrow(keyed.select("r", "text"), partial(_search_block, shared, shard_bytes), f"r binary, hits {_PAIRS}, items array<string>")
        # texts that repeat are one row of each task before they are shuffled
        found.append(tables.put(one.groupBy("r").agg(F.first("hits").alias("hits"), F.first("items").alias("items")), "hits"))
        shared.destroy()
    every = reduce(DataFrame.unionByName, found).groupBy("r").agg(
        F.flatten(F.collect_list("hits")).alias("hits"), F.flatten(F.collect_list("items")).alias("items")
    )
    every = tables.put(every, "all-hits")
    tables.keep(every)
    cells = every.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return map_arrow(keyed.join(cells, ["r", "cell"], "left").select("row", "text", "hits", "items"), partial(_merge, shard_bytes), done)


#: Hit words of a row, as SQL.
N_HIT = "aggregate(hits, 0L, (n, x) -> n + x.end - x.start)"


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with every benchmark passage cut out of the text (``n_chars``
    counted anew, if there is such a column); a document that keeps no word
    goes. Documents without a hit stay exactly as they are, empty ones too. A
    cut may bring the words beside it together; windows that arise so are not
    in the input and stay."""
    found = find(docs, benchmark, text_col=text_col, **options)
    clean = found.where(f"{N_HIT} < n_words OR n_words = 0").withColumn(
        "cut", F.expr(f"if(size(hits) > 0, {cut_spans('text', 'spans')}, text)")
    )

    def value(c: str):
        old = F.col(f"row.`{c}`")
        if c == text_col:
            return F.col("cut").alias(c)
        if c == "n_chars":
            return F.when(F.size("hits") > 0, F.length("cut")).otherwise(old).cast(docs.schema[c].dataType).alias(c)
        return old.alias(c)

    return clean.select(*map(value, docs.columns))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` and the
    removal spans of each document."""
    return find(docs, benchmark).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        F.expr(N_HIT).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        "spans",
    )


#: DuckDB SQL for ``digest`` (without the spans) over ``documents`` and ``benchmark``.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM bw),
dw AS (
  SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
m AS (SELECT dw.doc_id, dw.i, dw.k, bw.item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.g = bw.g),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY doc_id),
t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
       sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""

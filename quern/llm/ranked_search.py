"""Ranked lexical search of a stated query set over all documents, term at a
time with a limited number of accumulators.

The first pass cuts all texts into terms once and writes an inverted index of
segments: a segment is a run of documents of one task, with the postings
(document, number of occurrences) of the terms that the queries have, the
lengths of its documents, and for each term the largest count and the least
length. Its size is bounded by postings and by documents. From it come the
statistics of the whole collection (documents, terms, documents that hold a
term).

The second pass goes through the segments. For each query its terms are
processed from the rarest to the most common one. A posting's document gets an accumulator
as long as a document not seen so far could still reach the k best: once the
bounds of the terms that remain sum to less than the kth partial score (or the
kth score of the segments that this task has done), no more are created, and
those that exist are updated exactly, but for those that can no longer reach
that score. What is left of each task is k documents a query; these are merged
in two steps, so that no task merges more than a share of them.

Scores are whole numbers: a term's weight is ``floor(1000 ln((2N + 2) / (2 df + 1)))``,
a document's share of it ``(10**9 tf) div (1000 tf + 20 m)`` with
``m = 100 - 50 + (50 n N) div L``, and the score their sum of products over the query's different terms.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm.common import _FOLD, map_arrow, slices
from quern.session import ScratchTables

TOP = 50
SLICE_BYTES = 8 << 20
PIECE_BYTES = 4 << 20  # of a text that is cut into terms at a time
SEGMENT_POSTINGS = 1 << 20
SEGMENT_DOCS = 1 << 16
QUERY_BYTES = 1 << 20  # of query text in a block; a block is broadcast

_SEGMENT = "n_docs bigint, n_filled bigint, n_terms bigint, ids binary, null_ids binary, lens binary, terms binary, ends binary, docs binary, tfs binary"
_NAMES = [x.split()[0] for x in _SEGMENT.split(", ")]
_KINDS = [pa.int64()] * 3 + [pa.binary()] * 7


def terms_of(data: bytes) -> Iterator[list[bytes]]:
    """Terms of a UTF-8 text with A-Z lower-cased, in lists: a long text is
    folded and cut in pieces that end between two terms."""
    start = 0
    while len(data) - start > PIECE_BYTES:
        piece = data[start : start + PIECE_BYTES].translate(_FOLD)
        end = piece.rfind(b" ") + 1
        if not end:  # one term longer than a piece
            break
        yield piece[:end].split()
        start += end
    yield data[start:].translate(_FOLD).split()


# -------------------------------------------------------------------- index


class Builder:
    """Collects documents into a segment."""

    def __init__(self, vocabulary: dict[bytes, int]):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.ids: list[int | None] = []
        self.lens: list[int] = []
        self.postings: list[np.ndarray] = []
        self.n_postings = 0

    def add(self, doc_id: int | None, data: bytes) -> None:
        n, found = 0, []
        for words in terms_of(data):
            n += len(words)
            found.extend(x for x in map(self.vocabulary.get, words) if x is not None)
        if found:
            terms, tfs = np.unique(np.array(found, np.int64), return_counts=True)
            self.postings.append(np.stack([terms, np.full(len(terms), len(self.ids)), tfs]))
            self.n_postings += len(terms)
        self.ids.append(doc_id)
        self.lens.append(n)

    def segment(self) -> pa.RecordBatch:
        """The documents that hold a query's term with their postings, and the
        counts of all documents."""
        lens = np.array(self.lens, np.int64)
        terms, docs, tfs = np.concatenate([*self.postings, np.empty((3, 0), np.int64)], axis=1)
        kept, docs = np.unique(docs, return_inverse=True)
        order = np.argsort(terms, kind="stable")
        terms, docs, tfs = terms[order], docs[order], tfs[order]
        own, first = np.unique(terms, return_index=True)
        ends = np.append(first[1:], len(terms))[: len(own)]
        ids = [self.ids[i] for i in kept.tolist()]
        row = [
            len(lens), int((lens > 0).sum()), int(lens.sum()),
            np.array([x or 0 for x in ids], "<i8").tobytes(), np.array([x is None for x in ids], bool).tobytes(),
            lens[kept].astype("<i8").tobytes(), own.astype("<i4").tobytes(), ends.astype("<i4").tobytes(),
            docs.astype("<i4").tobytes(), tfs.astype("<i8").tobytes(),
        ]
        self.clear()
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, _KINDS, strict=True)], names=_NAMES)


def _index(shared, segment_docs: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    builder = Builder(shared.value)
    for batch in slices(batches, "text", SLICE_BYTES):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary()), strict=True):
            builder.add(doc_id, text.as_py() or b"")
            if builder.n_postings >= SEGMENT_POSTINGS or len(builder.ids) >= segment_docs:
                yield builder.segment()
    if builder.ids:
        yield builder.segment()


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each term, summed over the task's segments."""
    total: dict[int, int] = {}
    for batch in batches:
        for terms, ends in zip(batch.column("terms").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            counts = np.diff(np.frombuffer(ends, "<i4"), prepend=0)
            for t, n in zip(np.frombuffer(terms, "<i4").tolist(), counts.tolist(), strict=True):
                total[t] = total.get(t, 0) + n
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())], names=["term", "df"]
    )


# ------------------------------------------------------------------- search


def share(tf, m):
    """A document's share of a term's weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Segment:
    def __init__(self, row: dict, n_docs: int, n_terms: int):
        load = lambda name, kind: np.frombuffer(row[name], kind)
        self.ids, self.null = load("ids", "<i8"), load("null_ids", bool)
        self.terms = {t: i for i, t in enumerate(load("terms", "<i4").tolist())}
        self.ends = np.concatenate([[0], load("ends", "<i4")])
        self.docs, tfs = load("docs", "<i4"), load("tfs", "<i8")
        m = 50 + np.array([50 * n * n_docs // n_terms for n in load("lens", "<i8").tolist()], np.int64)
        self.shares = share(tfs, m[self.docs])
        # The share grows with the count and falls with the length.
        most, least = (np.maximum.reduceat(tfs, self.ends[:-1]), np.minimum.reduceat(m[self.docs], self.ends[:-1])) if len(tfs) else (tfs, m)
        self.bounds = share(most, least)


def search(segment: Segment, query: list[tuple[int, int]], k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The documents of a segment that may be among the k best of a query, with their scores, and the
    number of accumulators. ``query`` has (term, weight) from the rarest on;
    ``floor`` is a score that k documents of other segments reach."""
    terms = [(segment.terms[t], w) for t, w in query if t in segment.terms and w > 0]
    left = np.array([w * int(segment.bounds[i]) for i, w in terms] + [0])[::-1].cumsum()[::-1]
    score = np.zeros(len(segment.ids), np.int64)
    open_ = True  # whether accumulators are still created
    kth, made = floor, 0
    for step, (i, w) in enumerate(terms):
        if open_:
            if left[step] > kth and step and left[step] <= score.max():
                found = score[score > 0]
                if len(found) >= k:
                    kth = max(kth, int(np.partition(found, len(found) - k)[len(found) - k]))
            if left[step] < kth:
                open_, made = False, int((score > 0).sum())
        at = slice(segment.ends[i], segment.ends[i + 1])
        docs, gain = segment.docs[at], segment.shares[at] * w
        if not open_:
            # an accumulator that cannot reach the kth score any more is given up
            keep = (score[docs] > 0) & (score[docs] + left[step] >= kth)
            docs, gain = docs[keep], gain[keep]
        score[docs] += gain
    if open_:
        made = int((score > 0).sum())
    found = np.flatnonzero(score > 0)
    if len(found) > k:
        kth = np.partition(score[found], len(found) - k)[len(found) - k]
        found = found[score[found] >= kth]
    return found, score[found], made


def best(ids: np.ndarray, null: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k highest scores, equal ones by ascending id, null last."""
    return np.lexsort((ids, null, -scores))[:k]


def _search(shared, n_docs: int, n_terms: int, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    queries = shared.value
    held = [(np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64))] * len(queries)
    for batch in batches:
        for row in batch.to_pylist():
            segment = Segment(row, n_docs, n_terms)
            for q, query in enumerate(queries):
                ids, null, scores = held[q]
                found, got, _ = search(segment, query, k, int(scores[-1]) if len(scores) == k else 0)
                if len(found):
                    new = np.concatenate([ids, segment.ids[found]]), np.concatenate([null, segment.null[found]]), np.concatenate([scores, got])
                    first = best(*new, k)
                    held[q] = tuple(x[first] for x in new)
    sizes = [len(x[0]) for x in held]
    columns = [np.concatenate([np.empty(0, t), *(x[i] for x in held)]) for i, t in enumerate((np.int64, bool, np.int64))]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(np.arange(len(queries), dtype=np.int32), sizes)),
            pa.array(columns[0].astype(np.int64), mask=columns[1].astype(bool)),
            pa.array(columns[2].astype(np.int64)),
        ],
        names=["query", "doc_id", "score"],
    )


def _merged(found: DataFrame, k: int, salts: int) -> DataFrame:
    """The k best of each query: first among a share of the tasks' rows, then
    among the rows that are left."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    rank = F.row_number().over(Window.partitionBy("query", "salt").orderBy(*order))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
    first = salted.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank", "salt")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(*order))
    return first.withColumn("rank", rank).where(F.col("rank") <= k)


def rank(
    docs: DataFrame, items: DataFrame, *, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", query_bytes: int = QUERY_BYTES, segment_docs: int = SEGMENT_DOCS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each item the ``k`` documents of the
    highest score above 0, all if fewer; equal scores go by ascending id, null ids last.

    A null or empty text has no terms: such a document is never found, such an
    item finds nothing. Rows of ``docs`` are documents of their own even if they
    are equal. Items equal in id and text count once; one id with two texts is
    ranked twice. Ids of documents must be whole numbers. Empty tables give an
    empty result.

    The items are taken in blocks of at most ``query_bytes`` of text (a longer
    item comes alone); for each block the index of its terms is written and searched, and its result written.
    """
    spark = docs.sparkSession
    tables = ScratchTables(spark, "ranked")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text")).distinct()
    asked = asked.where("text is not null").withColumn("size", F.octet_length("text").cast("long"))
    size = asked.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    n_blocks = max(1, math.ceil(2 * size / query_bytes))
    asked = tables.put(asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)).cast("int")), "items")
    kind = asked.schema["item_id"].dataType.simpleString()
    path, schema = f"{tables.root}/ranked", f"item_id {kind}, rank int, doc_id bigint, score bigint"
    for block in range(n_blocks):
        for part in _blocks(asked.where(F.col("block") == block).orderBy("item_id", "text"), query_bytes):
            _block(texts, part, kind, k, segment_docs, tables, path)
    tables.drop(asked)
    return spark.read.schema(schema).parquet(path) if _written(spark, path) else spark.createDataFrame([], schema)


def _written(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _blocks(items: DataFrame, query_bytes: int) -> Iterator[list]:
    """The items of a block, again cut by size: only one cut is on the driver."""
    rows, size = [], 0
    for row in items.toLocalIterator():
        if rows and size + row.size > query_bytes:
            yield rows
            rows, size = [], 0
        rows.append(row)
        size += row.size
    if rows:
        yield rows


def _block(texts: DataFrame, items: list, kind: str, k: int, segment_docs: int, tables: ScratchTables, path: str) -> None:
    """Ranks a block of items and appends the rows to the table at ``path``."""
    spark = texts.sparkSession
    vocabulary: dict[bytes, int] = {}
    asked = [sorted({vocabulary.setdefault(t, len(vocabulary)) for x in terms_of(row.text.encode()) for t in x}) for row in items]
    words = spark.sparkContext.broadcast(vocabulary)
    index = tables.put(map_arrow(texts, partial(_index, words, segment_docs), _SEGMENT), "index")
    n, total = index.agg(F.coalesce(F.sum("n_filled"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    counts = map_arrow(index.select("terms", "ends"), _frequencies, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    df = {r.term: r.df for r in counts.collect()}  # as many rows as the block has terms
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * f + 1))) for t, f in df.items()}
    queries = [sorted(((t, weight[t]) for t in terms if t in df), key=lambda x: (df[x[0]], x[0])) for terms in asked]
    shared = spark.sparkContext.broadcast(queries)
    found = map_arrow(index, partial(_search, shared, n, max(total, 1), k), "query int, doc_id bigint, score bigint")
    ranked = _merged(found, k, int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = spark.createDataFrame([(i, row.item_id) for i, row in enumerate(items)], f"query int, item_id {kind}")
    out = ranked.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")
    out.write.mode("append").parquet(path)
    tables.drop(index)
    words.destroy()
    shared.destroy()


#: The same in DuckDB. Terms of lower-cased A-Z: the class leaves out the other ASCII signs.
ORACLE = r"""
WITH words AS (
  SELECT r, doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)),
postings AS (SELECT r, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM words GROUP BY r, term),
lens AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM postings GROUP BY r),
totals AS (SELECT count(*) AS cn, CAST(coalesce(sum(n), 0) AS BIGINT) AS cl FROM lens),
dfs AS (SELECT term, count(*) AS df FROM postings GROUP BY term),
items AS (SELECT DISTINCT item_id, text FROM benchmark),
asked AS (
  SELECT DISTINCT item_id, text, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM items),
scored AS (
  SELECT item_id, text, r, any_value(doc_id) AS doc_id, CAST(sum(
      CAST(floor(1000 * ln((2.0::DOUBLE * cn + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT)
      * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * cn) // cl)))) AS BIGINT) AS score
  FROM asked JOIN dfs USING (term) JOIN postings USING (term) JOIN lens USING (r) CROSS JOIN totals
  GROUP BY item_id, text, r),
ranked AS (
  SELECT item_id, doc_id, score,
    row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""

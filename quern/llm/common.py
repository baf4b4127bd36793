"""Shared pieces of the text operators: word cutting on bytes, word hashes,
and the slicing of Arrow batches into pieces of bounded size."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.session import checkpoint_root

#: A-Z to a-z, every other ASCII character but a-z and 0-9 to a space.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
#: The words that ``folded_words`` gives, as a pattern over lower-cased text.
FOLDED_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def folded_words(data: bytes) -> list[bytes]:
    """Words ``FOLDED_WORD`` of a UTF-8 text with A-Z lower-cased."""
    return data.translate(_FOLD).split()


def spaced_words(data: bytes) -> list[bytes]:
    r"""Words ``[^\x20\x09-\x0D]+`` of a UTF-8 text (``bytes.split`` cuts at
    exactly these characters)."""
    return data.split()


class WordHashes(dict):
    """word -> 64-bit hash; forgets all words at ``limit`` to stay bounded."""

    def __init__(self, limit: int = 1 << 20):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (Stafford's variant 13)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_STEP = np.uint64(0x9E3779B97F4A7C15)


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of each window of ``n`` word hashes (mod 2**64)."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:size].copy()
    for k in range(1, n):
        out *= _STEP
        out += hashes[k : k + size]
    return out


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """A string column as UTF-8 bytes, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose ``column`` (text, or lists of
    numbers) holds at most ``max_bytes`` (a longer single row comes alone)."""
    for batch in batches:
        values = batch.column(column)
        if pa.types.is_list(values.type):
            sizes = pc.multiply(pc.list_value_length(values), values.type.value_type.byte_width)
        else:
            sizes = pc.binary_length(values)
        sizes = sizes.fill_null(0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, n in enumerate(sizes):
            if total and total + n > max_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        if batch.num_rows > start:
            yield batch.slice(start)


def two(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text`` alone: other columns, whatever their names, stay out."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def row_key(id_col: Column, text_col: Column) -> list[Column]:
    """128 bits of a row's id and text: equal rows share it and are treated
    alike."""
    return [F.xxhash64(id_col, text_col).alias("r1"), F.xxhash64(F.lit(1), text_col, id_col).alias("r2")]


def cut_spans(text: str, spans: str) -> str:
    """SQL for ``text`` without its ``spans``; each becomes one line break, so
    the words around it do not join up to a new phrase inside a line."""
    return (
        f"concat_ws('\\n', transform(sequence(0, size({spans})), i -> substring({text}, "
        f"if(i = 0, 0, {spans}[i - 1].end) + 1, "
        f"if(i = size({spans}), length({text}), {spans}[i].start) - if(i = 0, 0, {spans}[i - 1].end))))"
    )


def packed(docs: DataFrame, **more: Column) -> DataFrame:
    """All columns of ``docs`` in one struct ``row`` and beside it only the
    named expressions, so that no name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[v.alias(k) for k, v in more.items()])


def with_field(batches: Iterator[pa.RecordBatch], at: int, name: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches of ``row`` with its field ``at`` beside it, not copied: a text
    that is in the row need not be sent a second time."""
    for batch in batches:
        row = batch.column("row")
        yield pa.RecordBatch.from_arrays([row, row.field(at)], names=["row", name])


_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Puts this package in the shared folder, from where executors that do not
    have it installed get it, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    target = f"{checkpoint_root(spark)}/{package.name}-{uuid.uuid4().hex[:12]}/{package.name}.zip"
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(data.getvalue())
    out.close()
    context.addPyFile(target)
    _shipped.add(context.applicationId)


def map_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with this package sent along."""
    _ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

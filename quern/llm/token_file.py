"""Token ids in binary files: one array of ids with Elias-Fano coded document
boundaries.

A file holds a run of documents in ascending order of id:

    ids          all ids side by side, 16 or 32 bits each, little-endian; from
                 byte 0 on, so the array can be mapped into memory as it is
    ends         Elias-Fano code of each document's end in that array
    doc ids      Elias-Fano code of the ids of the documents, less the lowest
    footer       sizes of the sections, counts, lowest id, magic (``_FOOTER``)

The documents are dealt into ranges of their ids and sorted; each task encodes
its range and streams it into files that end at ``file_ids`` ids or
``file_docs`` documents. A file's name is new for every attempt of a task,
and the manifest, a Parquet table that Spark commits, names the files that
count; what a lost attempt leaves is never read. A document's end is found by
select on the bit vector, so any run of documents is read without the rest.

The tokenizer runs on units of text that end where white space follows a
character that is none: the split pattern of byte-level BPE never runs across
such a place, so a unit has the same ids wherever it stands. Each is encoded once a slice, or once
a task while it is remembered, and the ids are put together by numpy.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm.common import map_arrow, slices
from quern.llm.elias_fano import EliasFano, encode
from quern.session import checkpoint_root

MAX_FILE_IDS = 1 << 26
MAX_FILE_DOCS = 1 << 18
READ_IDS = 1 << 21  # ids that a reader holds, or one document
MAX_TOKENIZER_BYTES = 64 << 20  # of a tokenizer's file; it is broadcast
MAX_UNITS = 1 << 20  # units whose ids a task remembers
LONG_UNIT = 64  # longer ones are not remembered
TOGETHER = 20_000  # units that are encoded as one text
SLICE_BYTES = 16 << 20
_FOOTER = struct.Struct("<QQQQQqB7x8s")
_MAGIC = b"QRNTOKEF"
#: White space by any definition (more does no harm).
_SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u2060\u3000\ufeff"
_CUT = re.compile(rf"[^{_SPACE}](?= )")
#: A space at the start or after white space, for Arrow.
_SPACED = re.sub(r"\\u(\w{4})", r"\\x{\1}", rf"[{_SPACE}] |\A ")
_SPACES = frozenset(x for x in map(chr, range(0x10000)) if re.match(f"[{_SPACE}]", x))

MANIFEST = "part int, seq int, path string, n_docs bigint, n_ids bigint, part_start bigint"


# ----------------------------------------------------------------- encoding


class UnitEncoder:
    """Texts to ids of one width as bytes, by a tokenizer of the ``tokenizers``
    library. Strings of special tokens in a text are ordinary text."""

    def __init__(self, data: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(data.decode())
        self.tokenizer.encode_special_tokens = True
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        kind = json.loads(data)
        pre = kind.get("pre_tokenizer") or {}
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        #: Whether texts may be cut into units; else each text is encoded whole.
        self.cuts = plain and not kind.get("normalizer") and kind["model"]["type"] == "BPE"
        self.known: dict[str, bytes] = {}
        # a token of byte-level BPE is written with one character a byte
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.sizes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.sizes[list(vocabulary.values())] = [len(x) for x in vocabulary]

    def _run(self, texts: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.dtype).tobytes() for x in got]

    def _run_units(self, units: list[str]) -> list[bytes]:
        """Ids of units that begin with a space and end with another character
        than white space, many of them as one text, which is cut up again by the lengths of the tokens."""
        out, width = [], self.dtype.itemsize
        for i in range(0, len(units), TOGETHER):
            some = units[i : i + TOGETHER]
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)[0].ids, self.dtype)
            ends = np.cumsum(self.sizes[ids])
            want = np.cumsum([len(x.encode()) for x in some])
            at = np.searchsorted(ends, want)
            if at[-1] != len(ids) - 1 or (ends[at] != want).any():
                raise AssertionError("a token runs across two units")
            raw, cuts = ids.tobytes(), [0, *((at + 1) * width).tolist()]
            out += [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        return out

    def _look_up(self, units: list[str]) -> list[bytes]:
        """Ids of each of the units, all different."""
        fresh = [u for u in units if u not in self.known]
        if len(self.known) + len(fresh) > MAX_UNITS:
            self.known.clear()
            fresh = units
        # A unit can stand among others if it begins with a space and does not end with white space.
        inner = [u for u in fresh if u[:1] == " " and u[-1] not in _SPACES]
        other = [u for u in fresh if not u or u[0] != " " or u[-1] in _SPACES]
        self.known.update(zip(inner, self._run_units(inner), strict=True))
        self.known.update(zip(other, self._run(other), strict=True))
        out = [self.known[u] for u in units]
        for u in fresh:
            if len(u) > LONG_UNIT:
                del self.known[u]
        return out

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text (null as empty)."""
        if not self.cuts:
            return self._run([x or "" for x in texts.to_pylist()])
        # Where each space follows another character than white space, a text is cut at its spaces by Arrow.
        texts = texts.fill_null("").cast(pa.large_string())
        plain = ~pc.match_substring_regex(texts, _SPACED).to_numpy(zero_copy_only=False).astype(bool)
        words = pc.split_pattern(texts.filter(pa.array(plain)), " ")
        flat = words.values.dictionary_encode()
        index, ends = flat.indices.to_numpy().astype(np.int64), words.offsets.to_numpy()
        keys = {" " + w: i for i, w in enumerate(flat.dictionary.to_numpy(zero_copy_only=False).tolist())}
        put = lambda u: keys.setdefault(u, len(keys))
        first = ends[:-1]
        index[first] = [put(w) for w in words.values.take(pa.array(first)).to_pylist()]
        rest = [[put(u) for u in _units(x)] for x in texts.filter(pa.array(~plain)).to_pylist()]
        ids = self._look_up(list(keys))
        sizes = np.array([len(x) for x in ids], np.int64) // self.dtype.itemsize
        flat_ids = np.frombuffer(b"".join(ids), self.dtype)
        starts = np.cumsum(sizes) - sizes
        cut, other = zip(ends, ends[1:], strict=False), iter(rest)
        return [self._joined(index[slice(*next(cut))] if p else np.array(next(other), np.int64), flat_ids, starts, sizes) for p in plain]

    def _joined(self, index: np.ndarray, ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> bytes:
        n = sizes[index]
        ends = np.cumsum(n)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[index] - (ends - n), n)
        return ids[at].tobytes()


def _units(text: str) -> Iterator[str]:
    """A text cut in front of each space that follows another character than
    white space."""
    start = 0
    for m in _CUT.finditer(text):
        yield text[start : m.end()]
        start = m.end()
    if start < len(text):
        yield text[start:]


@lru_cache(maxsize=2)
def _encoder(data: bytes) -> UnitEncoder:
    return UnitEncoder(data)


# --------------------------------------------------------------------- files


def _open(path: str):
    """File system and path, for any scheme that Arrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path) if ":" in path else "file://" + path)


class Writer:
    """Streams documents, in ascending order of id (nulls first), into a file."""

    def __init__(self, path: str, dtype: np.dtype):
        self.path, self.dtype = path, dtype
        self.fs, self.where = _open(path)
        self.out = self.fs.open_output_stream(self.where)
        self.doc_ids: list[int] = []
        self.ends: list[int] = []
        self.n_null = self.n_ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.out.write(ids)
        self.n_ids += len(ids) // self.dtype.itemsize
        self.ends.append(self.n_ids)
        if doc_id is None:
            self.n_null += 1
        else:
            self.doc_ids.append(doc_id)

    def close(self) -> None:
        ends = encode(np.array(self.ends, np.uint64))
        base = self.doc_ids[0] if self.doc_ids else 0
        docs = encode(np.array(self.doc_ids, np.int64).astype(np.uint64) - np.uint64(base % (1 << 64)))
        footer = _FOOTER.pack(
            self.n_ids, len(self.ends), self.n_null, len(ends), len(docs), base, self.dtype.itemsize, _MAGIC
        )
        self.out.write(ends + docs + footer)
        self.out.close()

    def discard(self) -> None:
        self.out.close()
        self.fs.delete_file(self.where)


class TokenFile:
    """Reads a file's documents by their position in it."""

    def __init__(self, path: str):
        fs, where = _open(path)
        size = fs.get_file_info(where).size
        self.file = fs.open_input_file(where)
        self.n_ids, self.n_docs, self.n_null, ends, docs, self.base, width, magic = _FOOTER.unpack(
            self.file.read_at(_FOOTER.size, size - _FOOTER.size)
        )
        if magic != _MAGIC:
            raise ValueError(f"{path}: not a file of token ids")
        self.dtype = np.dtype(f"<u{width}")
        self.ends = EliasFano(self.file.read_at(ends, self.n_ids * width))
        self.docs = EliasFano(self.file.read_at(docs, self.n_ids * width + ends))

    def offsets(self, first: int, last: int) -> np.ndarray:
        """Start of each document ``first`` to ``last`` (not included) in the
        array of ids, and the end of the last one."""
        index = np.arange(first, last + 1) - 1
        out = np.zeros(len(index), np.int64)
        out[index >= 0] = self.ends.get(index[index >= 0])
        return out

    def doc_ids(self, first: int, last: int) -> list[int | None]:
        index = np.arange(max(first, self.n_null), max(last, self.n_null)) - self.n_null
        got = (self.docs.get(index) + np.uint64(self.base % (1 << 64))).view(np.int64)
        return [None] * (last - first - len(index)) + got.tolist()

    def ids(self, start: int, end: int) -> np.ndarray:
        width = self.dtype.itemsize
        return np.frombuffer(self.file.read_at((end - start) * width, start * width), self.dtype)

    def runs(self, limit: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """Runs of documents that have up to ``limit`` ids (or one document), as
        first, last (not included) and offsets."""
        for block in range(0, self.n_docs, 4096):
            at = self.offsets(block, min(block + 4096, self.n_docs))
            first = 0
            while first < len(at) - 1:
                last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
                yield block + first, block + last, at[first : last + 1]
                first = last


# --------------------------------------------------------------------- Spark


def _write(root: str, shared, end_id: int, most: tuple[int, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    encoder, part = _encoder(shared.value), TaskContext.get().partitionId()
    end = np.array([end_id], encoder.dtype).tobytes()
    done, writer, start = [], None, 0
    try:
        for batch in slices(batches, "text", SLICE_BYTES):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text")), strict=True):
                if writer is None:
                    writer = Writer(f"{root}/{part:06d}-{len(done):04d}-{uuid.uuid4().hex}.tok", encoder.dtype)
                writer.add(doc_id, ids + end)
                if writer.n_ids >= most[0] or len(writer.ends) >= most[1]:
                    start, writer = _closed(writer, part, start, done)
        if writer is not None:
            _, writer = _closed(writer, part, start, done)
    except BaseException:
        if writer is not None:
            writer.discard()
        raise
    names = [x.split()[0] for x in MANIFEST.split(", ")]
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], t) for i, t in enumerate(kinds)], names=names)


def _closed(writer: Writer, part: int, start: int, done: list) -> tuple[int, None]:
    writer.close()
    done.append((part, len(done), writer.path, len(writer.ends), writer.n_ids, start))
    return start + writer.n_ids, None


def write(
    docs: DataFrame, tokenizer: str, *, path: str | None = None, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
    file_ids: int = MAX_FILE_IDS, file_docs: int = MAX_FILE_DOCS,
) -> str:
    """Encodes all documents, each with ``end_id`` behind it, into files under
    ``path`` (a new folder of the shared checkpoint folder if not given) and
    returns that folder. ``tokenizer`` is a JSON file of the ``tokenizers``
    library, read where the driver runs and broadcast (its size is checked).

    Documents come in ascending order of id; rows of one id in order of a hash of their text; null ids come
    first. A null text is empty, and an empty text has the end id alone. Ids
    must be whole numbers. An empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    with open(tokenizer, "rb") as f:
        data = f.read(MAX_TOKENIZER_BYTES + 1)
    if len(data) > MAX_TOKENIZER_BYTES:
        raise ValueError(f"{tokenizer}: a tokenizer's file may have {MAX_TOKENIZER_BYTES} bytes at most")
    path = path or f"{checkpoint_root(spark)}/quern-tokens-{uuid.uuid4().hex[:12]}"
    root = f"{path}/ids"
    _folder(spark, root)
    # The row's place parts rows that are equal in all, so that no range grows with their number.
    key = [F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("tie"), F.monotonically_increasing_id().alias("at")]
    rows = docs.select(F.col(text_col).cast("string").alias("text"), *key)
    dealt = rows.repartitionByRange("doc_id", "tie", "at").sortWithinPartitions("doc_id", "tie", "at").select("doc_id", "text")
    map_arrow(dealt, partial(_write, root, spark.sparkContext.broadcast(data), end_id, (file_ids, file_docs)), MANIFEST).write.parquet(f"{path}/manifest")
    return path


def _folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(where)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The files of a written folder: ``path, n_docs, n_ids, start``, the last
    one the number of ids in all files before it."""
    files = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # one row for each task of the write
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return files.join(starts, "part").select("path", "n_docs", "n_ids", (F.col("base") + F.col("part_start")).alias("start"))


def _read(digests: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, base in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
            file = TokenFile(path)
            for first, last, at in file.runs(READ_IDS):
                ids = file.ids(int(at[0]), int(at[-1])).astype("<u4")
                cut = at - at[0]
                if digests:
                    raw = memoryview(ids).cast("B")
                    more = pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(cut, cut[1:], strict=False)], pa.int64())
                else:
                    more = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(file.doc_ids(first, last), pa.int64()), pa.array(base + at[:-1]), pa.array(np.diff(at)), more],
                    names=["doc_id", "start", "n_tokens", "ids_crc32" if digests else "ids"],
                )


def read(spark: SparkSession, path: str, *, digests: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the files:
    ``start`` counts the ids of all documents before it, ``n_tokens`` the end id too. With ``digests``, instead of
    ``ids`` (array<int>), the CRC-32 of the ids as little-endian unsigned
    32-bit integers (``ids_crc32``)."""
    # A manifest is small, so the files are dealt to as many tasks as a shuffle has.
    files = manifest(spark, path).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")
    kind = "ids_crc32 bigint" if digests else "ids array<int>"
    return map_arrow(files, partial(_read, digests), f"doc_id bigint, start bigint, n_tokens bigint, {kind}")

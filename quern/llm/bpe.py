"""Byte-level BPE encoding and decoding with the tiktoken library over a local
rank file.

Long texts are cut before encoding, but only where the split pattern must
begin a new match: in front of a space or line break that follows a letter or
digit. No alternative of the pattern runs from a letter or digit into white
space, so the pieces, and with them the ids, are those of the whole text. A
stretch without such a place stays whole. A long run of white space, on which the split
would backtrack too deep, is one match of the pattern, less its last character
if text follows: it goes to the merges as it is.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import map_arrow, packed, slices, with_field

CHUNK_CHARS = 1 << 16
SLICE_BYTES = 8 << 20
MAX_RANK_BYTES = 64 << 20  # of a rank file; it is broadcast
_SAFE = re.compile(r"(?<=[0-9A-Za-z])(?=[ \n])")
#: White space as the split pattern has it, 4096 characters or more.
_BLANK = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")


def safe_chunks(text: str, size: int = CHUNK_CHARS) -> Iterator[str]:
    """``text`` in pieces of about ``size`` characters, cut at safe places."""
    start = 0
    while len(text) - start > size:
        m = _SAFE.search(text, start + size)
        if not m:
            break
        yield text[start : m.start()]
        start = m.start()
    yield text[start:]


@lru_cache(maxsize=4)
def encoding(ranks: bytes, pattern: str):
    import tiktoken

    pairs = (line.split() for line in ranks.splitlines() if line)
    return tiktoken.Encoding(
        "local", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={}
    )


def encode_text(enc, text: str, size: int = CHUNK_CHARS) -> list[int]:
    """Ids of the whole text, without special tokens."""
    if len(text) <= size:
        return enc.encode_ordinary(text)
    out: list[int] = []
    start = 0
    for m in _BLANK.finditer(text):
        end = m.end() - (m.end() < len(text))
        out += [i for part in safe_chunks(text[start : m.start()], size) for i in enc.encode_ordinary(part)]
        out += enc._encode_single_piece(text[m.start() : end])
        start = end
    return out + [i for part in safe_chunks(text[start:], size) for i in enc.encode_ordinary(part)]


def read_ranks(path: str) -> bytes:
    """The rank file, read where the driver runs. Its size is checked since it
    goes to every executor."""
    with open(path, "rb") as f:
        ranks = f.read(MAX_RANK_BYTES + 1)
    if len(ranks) > MAX_RANK_BYTES:
        raise ValueError(f"{path}: a rank file may have {MAX_RANK_BYTES} bytes at most")
    return ranks


def _encode(shared, text_at: int, digests: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    enc = encoding(*shared.value)
    for batch in slices(with_field(batches, text_at), "text", SLICE_BYTES):
        ids, n, ids_sha, text_sha = [], [], [], []
        for text in batch.column("text").to_pylist():
            got = np.array(encode_text(enc, text or ""), "<u4")
            n.append(len(got))
            if digests:
                ids_sha.append(hashlib.sha256(got.tobytes()).hexdigest())
                text_sha.append(hashlib.sha256(enc.decode_bytes(got.tolist())).hexdigest())
            else:
                ids.append(got.view(np.int32))
        more = [pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())] if digests else [_lists(ids, n)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(n, pa.int64()), *more],
            names=["row", "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids",))],
        )


def _lists(values: list[np.ndarray], sizes: list[int]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*values, np.empty(0, np.int32)]), pa.int32()))


def _decode(shared, ids_at: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    enc = encoding(*shared.value)
    for batch in slices(with_field(batches, ids_at, "ids"), "ids", SLICE_BYTES):
        # one document's ids at a time are Python numbers, which take ten times the memory
        data = [enc.decode_bytes(x.values.to_numpy().tolist()) if x.is_valid else None for x in batch.column("ids")]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(data, pa.binary())], names=["row", "data"])


def _shared(spark: SparkSession, path: str, pattern: str):
    return spark.sparkContext.broadcast((read_ranks(path), pattern))


def encode(docs: DataFrame, path: str, pattern: str, *, text_col: str = "text", digests: bool = False) -> DataFrame:
    """``row`` (all columns of ``docs`` as a struct), ``n_tokens`` and ``ids``
    (array<int>); with ``digests``, instead of the ids, the SHA-256 of the ids
    as little-endian 32-bit integers and of the bytes they decode to.

    Null and empty texts have no ids. One row out for each row in.
    """
    kinds = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>"
    inp = packed(docs)
    schema = f"row {inp.schema['row'].dataType.simpleString()}, n_tokens bigint, {kinds}"
    return map_arrow(inp, partial(_encode, _shared(docs.sparkSession, path, pattern), docs.columns.index(text_col), digests), schema)


def decode(tokens: DataFrame, path: str, pattern: str, *, ids_col: str = "ids") -> DataFrame:
    """``row`` (all columns of ``tokens``) and ``data``, the raw bytes of the
    ids (they need not be whole UTF-8); null ids give null."""
    inp = packed(tokens)
    schema = f"row {inp.schema['row'].dataType.simpleString()}, data binary"
    return map_arrow(inp, partial(_decode, _shared(tokens.sparkSession, path, pattern), tokens.columns.index(ids_col)), schema)

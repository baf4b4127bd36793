r"""Quality rules on repetition: rolling hashes of several n-gram lengths in
numpy, and the share of a text's word characters that lies in repeated n-grams
and lines.

Words are ``[^\x20\x09-\x0D]+``. N-grams are told apart by 64-bit hashes; two
different ones in one text meet with a chance of about 1e-11 for 20,000 words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quern.llm.common import WordHashes, map_arrow, mix, rolling, slices, spaced_words, texts, two

#: Largest share of word characters inside repeated n-grams, by n, and inside
#: lines that equal an earlier one. The share of lines counts only in what is
#: returned: one line of three said twice is no fault of a short text.
MAX_NGRAM_SHARE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
MAX_LINE_CHAR_SHARE = 0.20
MIN_WORDS, BASE_N, BASE_PERCENT = 10, 5, 20
SLICE_BYTES = 8 << 20

_SYMBOLS = b"#*$%&|<>"
_NOT_POINTS = bytes([0x20, *range(0x09, 0x0E), *range(0x80, 0xC0)])
_TAIL = bytes(range(0x80, 0xC0))
SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, dup_line_share double, dup_line_char_share double, "
    "dup_ngram_share array<double>"
)


def repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries occur twice or more, and which of these are not the first."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = np.zeros(len(s) + 1, bool)
    same[1:-1] = s[1:] == s[:-1]
    twice, later = np.zeros(len(s), bool), np.zeros(len(s), bool)
    twice[order] = same[1:] | same[:-1]
    later[order] = same[:-1]
    return twice, later


def covered(at: np.ndarray, n: int, total: int) -> np.ndarray:
    """Words inside the windows of ``n`` words that begin at ``at``."""
    edge = np.zeros(total + 1, np.int64)
    edge[at] += 1
    np.subtract.at(edge, at + n, 1)
    return np.cumsum(edge[:-1]) > 0


def line_repeats(data: bytes) -> tuple[int, int, int, int]:
    """Of the lines with a word: all, those equal to an earlier one, and the
    same in word characters."""
    seen: set[bytes] = set()
    lines = again = chars = again_chars = 0
    for line in data.split(b"\n"):
        n = len(line.translate(None, _NOT_POINTS))
        if n:
            lines += 1
            chars += n
            if line in seen:
                again += 1
                again_chars += n
            seen.add(line)
    return lines, again, chars, again_chars


def measure(docs: list[bytes], hashes: WordHashes) -> dict[str, list]:
    """The columns of ``SCHEMA`` but for ``doc_id``."""
    words = [spaced_words(d) for d in docs]
    n_words = np.array([len(w) for w in words], np.int64)
    starts = np.concatenate([[0], np.cumsum(n_words)])
    total = int(starts[-1])
    h = np.concatenate([np.empty(0, np.uint64), *(hashes.array(w) for w in words)])
    doc = np.repeat(np.arange(len(docs)), n_words)
    left = starts[1:][doc] - np.arange(total)  # words from here to the end of the text
    salt = mix(doc.astype(np.uint64) + np.uint64(1))
    word_chars = [len(d.translate(None, _NOT_POINTS)) for d in docs]

    at = np.flatnonzero(left >= BASE_N)
    twice, _ = repeats(rolling(h, BASE_N)[at] ^ salt[at]) if len(at) else (np.zeros(0, bool),) * 2
    repeat = covered(at[twice], BASE_N, total)
    n_repeat = np.bincount(doc[repeat], minlength=len(docs))

    # longer n-grams repeat only where their first BASE_N words do
    at = at[twice]
    points = np.zeros(total, np.int64)
    for d in np.unique(doc[at]):
        a = int(starts[d])
        points[a : a + len(words[d])] = [len(w.translate(None, _TAIL)) for w in words[d]]
    shares = {}
    for n in MAX_NGRAM_SHARE:
        fit = at[left[at] >= n]
        if len(fit):
            key = h[fit].copy()
            for k in range(1, n):
                key *= np.uint64(0x9E3779B97F4A7C15)
                key += h[fit + k]
            _, later = repeats(key ^ salt[fit])
            inside = covered(fit[later], n, total)
            chars = np.bincount(doc[inside], weights=points[inside], minlength=len(docs))
        else:
            chars = np.zeros(len(docs))
        shares[n] = chars / np.maximum(word_chars, 1)

    lines = [line_repeats(d) for d in docs]
    line_share = [again / max(1, n) for n, again, _, _ in lines]
    line_char_share = [again / max(1, n) for _, _, n, again in lines]
    failed = [int(n) < MIN_WORDS or 100 * int(r) > BASE_PERCENT * int(n) for n, r in zip(n_words, n_repeat, strict=True)]
    kept = [
        not bad
        and line_char_share[i] <= MAX_LINE_CHAR_SHARE
        and all(shares[n][i] <= most for n, most in MAX_NGRAM_SHARE.items())
        for i, bad in enumerate(failed)
    ]
    return {
        "n_words": n_words.tolist(),
        "word_chars": word_chars,
        "n_symbols": [len(d) - len(d.translate(None, _SYMBOLS)) for d in docs],
        "n_dup_lines": [again for _, again, _, _ in lines],
        "n_repeat_words": n_repeat.tolist(),
        "base_failed": failed,
        "kept": kept,
        "dup_line_share": line_share,
        "dup_line_char_share": line_char_share,
        "dup_ngram_share": [[float(shares[n][i]) for n in MAX_NGRAM_SHARE] for i in range(len(docs))],
    }


def _rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in slices(batches, "text", SLICE_BYTES):
        columns = measure(texts(batch.column("text")), hashes)
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **columns})


def rules(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    r"""One row of ``SCHEMA`` for each row of ``docs``.

    ``word_chars``: code points in words. ``n_symbols``: characters of
    ``#*$%&|<>``. ``n_dup_lines``: \n-split lines with a word that equal an
    earlier line. ``n_repeat_words``: words in 5-word windows found twice or
    more in the text, the first included. ``base_failed``: fewer than 10 words,
    or 100 * n_repeat_words > 20 * n_words. ``dup_ngram_share``: for n of 5 to
    10, word characters inside n-grams seen before in the text, as a share of
    all. ``kept``: not base_failed, and no share over its limit. Null and empty
    texts have no words and fail; rows that repeat are measured each on its own.
    """
    inp = two(docs, id_col, text_col)
    kind = inp.schema["doc_id"].dataType.simpleString()
    return map_arrow(inp, _rules, SCHEMA.replace("doc_id bigint", f"doc_id {kind}"))

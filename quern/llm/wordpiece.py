"""Token counts by a linear longest-match automaton.

The vocabulary's pieces form two tries, of pieces that begin a word and of
pieces that continue one. Each node has a failure link and the number of
pieces that following it pops, so a word's greedy longest-match count comes
from one walk over its characters, and no piece is ever built.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame

from quern.llm.common import map_arrow, slices, texts, two

SLICE_BYTES = 8 << 20
MEMO = 1 << 19  # words whose counts a task remembers
MAX_VOCABULARY_BYTES = 64 << 20
#: Words: letters, digits and non-ASCII characters in sequence; any other
#: visible ASCII character alone.
WORD = re.compile(rb"[0-9A-Za-z\x80-\xFF]+|[!-/:-@\[-`{-~]")
_SHIFT = 21  # bits of a code point


class Automaton(dict):
    """word (UTF-8) -> number of greedy longest-match pieces; -1 if some part
    matches no piece. Counts are kept for up to ``MEMO`` words."""

    START, INSIDE = 0, 1

    def __init__(self, first: Iterable[str], later: Iterable[str]):
        super().__init__()
        child: dict[int, int] = {}
        whole = [False, False]
        levels: list[list[tuple[int, int, int]]] = []  # by depth: parent, character, node
        for root, pieces in ((self.START, first), (self.INSIDE, later)):
            for piece in pieces:
                node = root
                for depth, c in enumerate(piece):
                    key = node << _SHIFT | ord(c)
                    if key not in child:
                        child[key] = len(whole)
                        while depth >= len(levels):
                            levels.append([])
                        levels[depth].append((node, ord(c), len(whole)))
                        whole.append(False)
                    node = child[key]
                if piece:
                    whole[node] = True
        link, pops = [-1] * len(whole), [0] * len(whole)
        for parent, c, node in (x for level in levels for x in level):
            if whole[node]:
                link[node], pops[node] = self.INSIDE, 1
                continue
            to, n = link[parent], pops[parent]
            while to >= 0 and to << _SHIFT | c not in child:
                n += pops[to]
                to = link[to]
            if to >= 0:
                link[node], pops[node] = child[to << _SHIFT | c], n
        self.child, self.link, self.pops = child, link, pops

    def count(self, word: str) -> int:
        child, link, pops = self.child, self.link, self.pops
        node, n = self.START, 0
        for c in map(ord, word):
            while (to := child.get(node << _SHIFT | c)) is None:
                if link[node] < 0:
                    return -1
                n += pops[node]
                node = link[node]
            node = to
        while node != self.INSIDE:
            if link[node] < 0:
                return -1 if word else 0
            n += pops[node]
            node = link[node]
        return n

    def __missing__(self, word: bytes) -> int:
        n = self.count(word.decode("utf-8", "replace"))
        if len(word) <= 64:
            if len(self) >= MEMO:
                self.clear()
            self[word] = n
        return n


def sentencepiece_vocabulary(path: str, mark: str = "▁") -> tuple[list[str], list[str]]:
    """Pieces of a sentencepiece model: those with the word mark begin words,
    the others continue them; control, unknown and byte pieces stay out."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [p.id_to_piece(i) for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i))]
    first = [x[len(mark) :] for x in plain if x.startswith(mark) and len(x) > len(mark)]
    return first, [x for x in plain if mark not in x]


@lru_cache(maxsize=2)
def _automaton(first: tuple[str, ...], later: tuple[str, ...]) -> Automaton:
    return Automaton(first, later)


def _count(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = _automaton(*shared.value)
    for batch in slices(batches, "text", SLICE_BYTES):
        n_words, n_pieces, n_unknown = [], [], []
        for data in texts(batch.column("text")):
            counts = list(map(automaton.__getitem__, WORD.findall(data)))
            unknown = counts.count(-1)
            n_words.append(len(counts))
            n_unknown.append(unknown)
            n_pieces.append(sum(counts) + 2 * unknown)  # an unknown word is one piece
        yield pa.RecordBatch.from_pydict(
            {"doc_id": batch.column("doc_id"), "n_words": n_words, "n_pieces": n_pieces, "n_unknown": n_unknown}
        )


def token_counts(
    docs: DataFrame, first: Iterable[str], later: Iterable[str], *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_words, n_pieces, n_unknown`` for each row of ``docs``.

    ``first`` and ``later``: pieces that begin and that continue a word; at
    each place the longest one that fits is taken. A word that cannot be cut
    up so is unknown and counts as one piece. Null and empty texts have no
    words; rows that repeat are counted each on its own; an empty vocabulary
    makes every word unknown.
    """
    vocabulary = tuple(first), tuple(later)
    if sum(len(x.encode()) for part in vocabulary for x in part) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"the pieces may have {MAX_VOCABULARY_BYTES} bytes at most")
    inp = two(docs, id_col, text_col)
    kind = inp.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    return map_arrow(inp, partial(_count, shared), f"doc_id {kind}, n_words bigint, n_pieces bigint, n_unknown bigint")

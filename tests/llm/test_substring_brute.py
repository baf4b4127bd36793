"""op3_substring_dedup against a brute force: every unit as its words, every
window of the winnowing looked at by itself, all occurrences in one dictionary."""

import re
from collections import defaultdict

import pytest
import xxhash

from conftest import SF_SMALL
from quern.llm import catalog, substring_dedup
from quern.llm.common import FOLDED_WORD, table

MASK = (1 << 64) - 1
UPPER = {c: c + 32 for c in range(65, 91)}


def _order(word: str) -> int:
    """Place of a word in the winnowing: 38 bits of its mixed hash."""
    x = (xxhash.xxh64_intdigest(word.encode()) + 1) & MASK
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = ((x ^ (x >> shift)) * factor) & MASK
    return (x ^ (x >> 31)) >> 26


def _units(text: str) -> dict[tuple[int, int], tuple[int, int]]:
    """(first word, word after the last) -> (start, end) in code points."""
    words = [(m.start(), m.end()) for m in re.finditer(FOLDED_WORD, text.translate(UPPER))]
    orders = [_order(text[a:b].translate(UPPER)) for a, b in words]
    n, w = len(words), substring_dedup.WINNOW
    begins = {0} if n else set()
    for i in range(n - w + 1):
        least = min(orders[i : i + w])
        begins.add(max(k for k in range(i, i + w) if orders[k] == least))
    found = {}
    for a in sorted(begins):
        if n - a >= substring_dedup.UNIT_WORDS:
            b = min([x for x in begins if x >= a + substring_dedup.UNIT_WORDS], default=n)
            found[a, b] = words[a][0], words[b - 1][1]
    edges = [-1, *(m.start() for m in re.finditer(r"[\r\n]", text)), len(text)]
    rows = [(edges[k] + 1, edges[k + 1]) for k in range(len(edges) - 1)]
    blank = [m.end() for m in re.finditer(r"(?:\n|\r(?!\n))[ \t\r]*(?:\n|\r(?!\n))", text)]
    parts = []
    for lo, hi in zip([0, *blank], [*blank, len(text) + 1], strict=True):
        inside = [(a, b) for a, b in rows if lo <= a < hi and any(a <= s < b for s, _ in words)]
        if len(inside) > 1:
            parts.append((inside[0][0], inside[-1][1]))
    for a, b in rows + parts:
        own = [k for k, (s, _) in enumerate(words) if a <= s < b]
        if len(own) >= substring_dedup.LINE_WORDS:
            found[own[0], own[-1] + 1] = a, b
    return found


def _spans(docs: list[tuple[int, str]]) -> list[tuple[int, int, int, int]]:
    where = defaultdict(list)
    for doc_id, text in docs:
        words = [w.translate(UPPER) for w in re.findall(FOLDED_WORD, text.translate(UPPER))]
        for (a, b), place in _units(text).items():
            where[tuple(words[a:b])].append((doc_id, a, b, place))
    gone = defaultdict(list)
    for held in where.values():
        held.sort()
        for doc_id, _, _, place in held[1:]:
            gone[doc_id].append((*place, held[0][0]))
    out = []
    for doc_id, places in gone.items():
        start = end = kept = None
        for a, b, k in sorted(places):
            if end is not None and a <= end:
                end, kept = max(end, b), min(kept, k)
                continue
            if end is not None:
                out.append((doc_id, start, end, kept))
            start, end, kept = a, b, k
        out.append((doc_id, start, end, kept))
    return sorted(out)


def test_query_equals_brute_force_on_the_table(spark):
    docs = [(r.doc_id, r.text or "") for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    got = sorted(map(tuple, catalog.op3_substring_dedup(spark, SF_SMALL).collect()))
    want = _spans(docs)
    assert got == want
    assert want


@pytest.mark.parametrize("end", ["\n", "\r", "\r\n"])
def test_lines_paragraphs_and_passages_equal_brute_force(spark, end):
    passage = " ".join(f"pässage{i}" for i in range(60))
    loop = " ".join(["one two three four five"] * 12)
    rows = [
        (1, end.join(["own words of one", "", passage, "Shared LINE, of words", "two words"])),
        (2, end.join(["begin " + passage + " and an end", "shared line of words!", "", "two words"])),
        (3, end.join(["* shared line of words", "shared line of words", "", "two words"])),
        (4, loop),
        (5, "x " + loop + end + end + "own words of one"),
        (6, "  " + end + " \t" + end),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, substring_dedup.spans(docs).collect())) == _spans(rows)

"""The cores of the text operators against plain versions, without Spark."""

import random
import re
import time
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer, models

from quern.llm import bpe, decontam, html_text, license_scan, minhash, quality, repetition, substring_dedup, wordpiece
from quern.llm.common import FOLDED_WORD, WordHashes, folded_words, spaced_words

RANKS = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
ODD_TEXTS = ["", " ", "\n\n", "a", "A b\tc\x0b d", "é È ß 　 x y", "x" * 5000, "don't  stop\n \n'll", "1a2b ñ\x00z"]


def test_words_are_those_of_the_patterns():
    for t in ODD_TEXTS:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
        assert [w.decode() for w in folded_words(t.encode())] == re.findall(FOLDED_WORD, lower)
        assert [w.decode() for w in spaced_words(t.encode())] == re.findall(r"[^\x20\x09-\x0D]+", t)


# ----------------------------------------------------------------------- bpe


def test_chunks_change_no_id():
    enc = bpe.encoding(RANKS, P.PATTERN)
    rng = random.Random(1)
    parts = ["word", " word", "  ", "\n", "\n\n", " 12", "'s", "é", "!?", "\t", "日本", " x", "\r\n", "　"]
    for _ in range(300):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 80)))
        assert bpe.encode_text(enc, t, size=rng.randint(1, 20)) == enc.encode_ordinary(t)
        assert "".join(bpe.safe_chunks(t, 7)) == t
        assert enc.decode_bytes(enc.encode_ordinary(t)) == t.encode()


def test_decoding_holds_little_of_a_large_batch_at_once():
    enc = bpe.encoding(RANKS, P.PATTERN)
    texts = [f"document {i} of a batch with many ids, " * 150 for i in range(3000)] + [None, ""]
    ids = [None if t is None else enc.encode_ordinary(t) for t in texts]
    column = pa.array(ids, pa.list_(pa.int32()))
    row = pa.StructArray.from_arrays([pa.array(range(len(ids))), column], names=["n", "ids"])
    batch = pa.RecordBatch.from_arrays([row], names=["row"])  # the ids cross to Python in their row only
    del ids
    tracemalloc.start()
    done, most = [], 0
    for part in bpe._decode(SimpleNamespace(value=(RANKS, P.PATTERN)), 1, iter([batch])):
        most = max(most, part.num_rows)
        done += zip(part.column("row").field(0).to_pylist(), part.column("data").to_pylist(), strict=True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < len(texts) and column.nbytes > bpe.SLICE_BYTES
    assert peak < 8 * column.nbytes
    assert done == [(i, None if t is None else t.encode()) for i, t in enumerate(texts)]


# ------------------------------------------------------------------ decontam


def _hits(docs, items, window):
    out = []
    for d in docs:
        hit, names = [False] * len(d), set()
        for name, text in items:
            w = folded_words((text or "").encode())
            size = min(window, len(w))
            for i in range(len(w) - size + 1) if w else ():
                for j in range(len(d) - size + 1):
                    if d[j : j + size] == w[i : i + size]:
                        names.add(str(name))
                        hit[j : j + size] = [True] * size
        out.append((hit, sorted(names)))
    return out


def test_fm_index_finds_every_occurrence():
    rng = random.Random(3)
    words = [b"a", b"b", b"c", b"d", b"e", b"zz", b"q"]
    for _ in range(150):
        docs = [[rng.choice(words) for _ in range(rng.choice([0, 1, 3, 10, 40, 90]))] for _ in range(rng.choice([1, 2, 5]))]
        docs += docs[:1] * rng.randint(0, 3)
        items = [(i, " ".join(rng.choice("abcdez") for _ in range(rng.choice([0, 1, 2, 3, 5, 9])))) for i in range(4)]
        phrases = decontam.phrases_of(items, 3)
        hit, starts, found = decontam.search_shard(docs, phrases)
        for k, (expected, names) in enumerate(_hits(docs, items, 3)):
            assert hit[starts[k] : starts[k + 1]].tolist() == expected
            assert sorted(phrases.names[i] for i in found[k]) == names


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(5)
    for _ in range(100):
        seq = np.append(rng.integers(0, 3, rng.integers(1, 60)), 0)
        seps = np.cumsum(seq == 0)
        key = [(int(s) - 1 if v == 0 else 1000 + int(v)) for v, s in zip(seq, seps, strict=True)]
        expected = sorted(range(len(seq)), key=lambda i: key[i:])
        assert decontam.suffix_array(seq).tolist() == expected


# ---------------------------------------------------------------- repetition


def _measured(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    five = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    inside = {j for i in range(len(w) - 4) if five[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    total = sum(map(len, w))
    shares = []
    for n in repetition.MAX_NGRAM_SHARE:
        seen, covered = set(), set()
        for i in range(len(w) - n + 1):
            key = tuple(w[i : i + n])
            if key in seen:
                covered.update(range(i, i + n))
            seen.add(key)
        shares.append(sum(len(w[i]) for i in covered) / max(1, total))
    return len(w), total, sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(inside), shares


def test_repetition_measures():
    rng = random.Random(5)
    parts = ["a", "bé", "c#", " x", "é", "\n", "\n", "\t ", "ü", "y", "$<"]
    docs = ["", "\n\n", *ODD_TEXTS] + [" ".join(rng.choice(parts) for _ in range(rng.choice([0, 3, 9, 12, 30, 60, 200]))) for _ in range(200)]
    got = repetition.measure([d.encode() for d in docs], WordHashes())
    for i, d in enumerate(docs):
        *base, shares = _measured(d)
        assert [got[k][i] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] == base
        assert got["dup_ngram_share"][i] == pytest.approx(shares)
        failed = base[0] < 10 or 100 * base[4] > 20 * base[0]
        assert got["base_failed"][i] == failed and not (failed and got["kept"][i])


def test_the_verdict_follows_from_the_shares():
    rng = random.Random(6)
    unlike = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    docs = []
    for _ in range(150):
        again = ["long" * rng.choice([0, 9]) + w for w in unlike(rng.choice([5, 6, 10, 20]))]
        words = [*unlike(rng.randint(10, 120)), *again, *unlike(rng.randint(0, 60)), *again[: rng.choice([5, 10, 20])]]
        line = rng.choice(["", "long" * 9]) + " ".join(unlike(rng.randint(1, 4)))
        lines = [x for _ in range(rng.randint(1, 9)) for x in (line, " ".join(unlike(3)))]
        docs.append("\n".join([" ".join(words if rng.random() < 0.5 else unlike(20)), *lines, " ".join(unlike(30))]))
    got = repetition.measure([d.encode() for d in docs], WordHashes())
    seen = set()
    for i, d in enumerate(docs):
        n_words, _, _, _, n_repeat, shares = _measured(d)
        lines = [x for x in d.split("\n") if x.split()]
        chars = lambda some: sum(len(w) for x in some for w in x.split())
        line_share = 1 - chars(dict.fromkeys(lines)) / chars(lines)
        assert got["dup_line_char_share"][i] == pytest.approx(line_share)
        bad = n_words < 10 or 100 * n_repeat > 20 * n_words
        over = [s > most for s, most in zip(shares, repetition.MAX_NGRAM_SHARE.values(), strict=True)]
        kept = not bad and line_share <= repetition.MAX_LINE_CHAR_SHARE and not any(over)
        assert got["kept"][i] == kept
        seen.add((bad, line_share > repetition.MAX_LINE_CHAR_SHARE, any(over)))
    assert {(False, False, False), (False, True, False), (False, False, True)} <= seen


# ----------------------------------------------------------------- wordpiece


def _greedy(word, first, later):
    i = n = 0
    while i < len(word):
        pieces = later if i else first
        j = next((j for j in range(len(word), i, -1) if word[i:j] in pieces), None)
        if j is None:
            return -1
        i, n = j, n + 1
    return n


def test_automaton_counts_greedy_pieces():
    rng = random.Random(7)
    some = lambda k: {"".join(rng.choice("abé") for _ in range(rng.randint(1, 5))) for _ in range(k)}
    for _ in range(200):
        first, later = some(rng.randint(0, 12)), some(rng.randint(0, 12))
        automaton = wordpiece.Automaton(first, later)
        for w in [*some(40), "", "abéabéabéaabb"]:
            assert automaton[w.encode()] == _greedy(w, first, later)


def test_automaton_agrees_with_the_tokenizers_library():
    first, later = wordpiece.sentencepiece_vocabulary(P.path("piece_bpe_32k.model"))
    vocabulary = {"[UNK]": 0}
    for piece in [*first, *("##" + x for x in later)]:
        vocabulary.setdefault(piece, len(vocabulary))
    model = Tokenizer(models.WordPiece(vocabulary, unk_token="[UNK]", max_input_chars_per_word=10_000))
    automaton = wordpiece.Automaton(first, later)
    for w in ["thereof", "unbelievable", "Straße", "日本語", "x" * 300, "กข", "a1b2", "zzzzq"]:
        tokens = model.encode(w).tokens
        assert automaton[w.encode()] == (-1 if tokens == ["[UNK]"] else len(tokens))


# ----------------------------------------------------------------------- html


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("   ", ""),
        ("plain  words &amp; more", "plain words & more"),
        ("<article><h1>T</h1><p>a &lt;b&gt;\n c</p><p>x<br>y</article><footer>f</footer>", "T\na <b> c\nx y"),
        ("<nav><a href=x>m</a></nav><main><p>Long enough text of a page, with words.</p><p>No.</p></main>", "Long enough text of a page, with words.\nNo."),
        ("<article><p>one<p>two<script>var t='</p>';</script><style>p{}</style><p>three &am", "one\ntwo\nthree &am"),
        ("<article><p>one</p><aside>side</aside><form><p>Your name</p></form><p>two</p><div", "one\ntwo"),
        ("<article><p>a</p><section class='comments'><p>first!</p></section></article>", "a"),
        ("<article><p>a</p><!-- <p>no</p> --><div class='ad'>buy</div><p>b</p></article>", "a\nb"),
        ("<article><ul><li>1<li>2</ul><table><tr><td>a<td>b<tr><td>c</table></article>", "1\n2\na b\nc"),
        ("<article><p>a</p></article><div id='cookie-notice'><p>We use cookies.</p></div>", "a"),
        ("<form><article><p>in a form that holds the whole page</p></article></form>", "in a form that holds the whole page"),
    ],
)
def test_html(page, text):
    assert html_text.extract(page) == text


def test_html_without_article_keeps_the_region_with_the_text():
    body = "".join(f"<p>Paragraph {i} has a number of words that make it long enough.</p>" for i in range(5))
    page = f"<div id=menu><ul><li><a href=a>Home</a><li><a href=b>News</a></ul></div><div id=c>{body}<p>Ok.</p></div><div><a href=z>More links here</a></div>"
    assert html_text.extract(page).split("\n") == [*(f"Paragraph {i} has a number of words that make it long enough." for i in range(5)), "Ok."]


_BODY = "".join(f"<p>Paragraph {i} has a number of words that make it long enough to be the text of a page.</p>" for i in range(5))


@pytest.mark.parametrize(
    "page",
    [
        "<div id=content>%s</div><article><a href=x>Card one</a></article><article><h3>Card two</h3></article>",
        "<main><div>%s</div></main><article><h3>Card</h3></article>",
        "<article class='teaser sponsored'><p>Buy this thing, which is the best that was ever offered to anybody here.</p></article><div id=c>%s</div>",
        "<div class='page with-sidebar'><main>%s</main><div class=sidebar><p>Aside.</p></div></div>",
        "<div class='layout nav-open'><article>%s</article></div>",
        "<div class='layout nav-open'><nav><a href=x>m</a><article>%s<div class=related><p>More.</p></div></article></div>",
        "<article class='post comments-open'>%s</article><div id=comments><article><p>A comment as long as a paragraph of the text on this page.</p></article></div>",
    ],
)
def test_html_article_is_a_container_among_others(page):
    lines = html_text.extract(page.replace("%s", _BODY)).split("\n")
    assert len(lines) == 5 and all(x.startswith("Paragraph") for x in lines)


def test_html_of_odd_markup_ends():
    for s in ("<" * 20_000, "<!" * 20_000, "<a " * 20_000, "&" * 20_000, "</" * 20_000, "<div>" * 3000 + "x", "<p>x" * 5000):
        html_text.extract(s)


# -------------------------------------------------------------------- minhash


def _probability_jaccard(x, y):
    keys = {*x, *y}
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in keys) for i in x if i in y)


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(20):
        n = int(rng.integers(5, 60))
        elements = rng.integers(1, 2**63, n).astype(np.uint64)
        a = rng.integers(0, 6, n)
        b = np.where(rng.random(n) < 0.6, a, rng.integers(0, 6, n))
        x, y = ({int(e): int(w) for e, w in zip(elements, ws, strict=True) if w} for ws in (a, b))
        if x and y:
            doc = np.array([0] * len(x) + [1] * len(y))
            s = minhash.signatures(doc, np.array([*x, *y], np.uint64), np.array([*x.values(), *y.values()]), 2, 1500)
            errors.append((s[0] == s[1]).mean() - _probability_jaccard(x, y))
    assert max(map(abs, errors)) < 0.06 and abs(np.mean(errors)) < 0.015


def test_signatures_do_not_depend_on_the_batch():
    rng = np.random.default_rng(2)
    docs = [rng.integers(1, 2**63, rng.integers(1, 300)).astype(np.uint64) for _ in range(20)]
    together = minhash.signatures(np.repeat(np.arange(20), list(map(len, docs))), np.concatenate(docs), np.ones(sum(map(len, docs))), 20, 64)
    for i, d in enumerate(docs):
        assert (minhash.signatures(np.zeros(len(d), int), d, np.ones(len(d)), 1, 64)[0] == together[i]).all()


def test_shingles_are_counted():
    words = [b"a b c d e a b c d e".split(), [], b"x y".split(), b"a b c d e".split()]
    doc, value, count = minhash.shingles(words, WordHashes())
    assert Counter(doc.tolist()) == {0: 5, 2: 1, 3: 1} and sorted(count.tolist()) == [1, 1, 1, 1, 1, 1, 2]
    assert value[doc == 3][0] in value[doc == 0]


def test_counted_and_plain_bands_have_keys_of_their_own():
    same = np.ones((1, 15), np.uint64)
    assert len({*minhash.band_keys(same, 3, 5)[0].tolist(), *minhash.band_keys(same, 3, 5, 3)[0].tolist()}) == 6


# -------------------------------------------------------------------- licence


def test_licence_pruning_loses_nothing():
    rng = random.Random(4)
    for name, template in license_scan.TEMPLATES.items():
        grams = license_scan.bigrams(template)
        words = re.findall("[a-z0-9]+", template.lower())
        needles = license_scan.needles(grams, 0.9)
        low, high = license_scan.bounds(len(grams), 0.9)
        for _ in range(60):
            w = words.copy()
            for _ in range(rng.randint(0, max(1, len(w) // 12))):
                w[rng.randrange(len(w))] = rng.choice(["foo", w[0], ""])
            unit = license_scan.bigrams(" ".join(w))
            if 2 * len({*unit} & {*grams}) / (len(unit) + len(grams)) >= 0.9:
                assert low <= len(unit) <= high and needles & {*w}, name


# --------------------------------------------------------------- substrings


def test_a_shared_passage_always_shares_a_unit():
    rng = random.Random(9)
    draw = lambda n: [b"w%d" % rng.randrange(500) for _ in range(n)]
    for _ in range(300):
        passage = draw(2 * substring_dedup.WINNOW + substring_dedup.UNIT_WORDS + 1)
        docs = [draw(rng.randint(0, 40)) + passage + draw(rng.randint(0, 40)) for _ in range(2)]
        doc, a, b, d1, d2, again = substring_dedup.units(docs, WordHashes(), substring_dedup.WINNOW, substring_dedup.UNIT_WORDS)
        keys = [{k for k, d in zip(zip(d1.tolist(), d2.tolist(), strict=True), doc, strict=True) if d == i} for i in (0, 1)]
        assert keys[0] & keys[1]
        words = {k: docs[d][i:j] for k, d, i, j in zip(zip(d1.tolist(), d2.tolist(), strict=True), doc, a, b, strict=True)}
        assert all(len(w) >= substring_dedup.UNIT_WORDS for w in words.values())


def test_lines_and_paragraphs_are_units():
    text = "Éa b c.\r\n- d e f!\n \t\n\ng h\ni\n--\nj k l"
    found = [(text.encode()[s:e].decode(), b - a) for a, b, s, e in substring_dedup.lines(text.encode(), 3).tolist()]
    assert found == [("Éa b c.", 3), ("- d e f!", 3), ("j k l", 3), ("Éa b c.\r\n- d e f!", 6), ("g h\ni\n--\nj k l", 6)]
    assert not len(substring_dedup.lines(b"\n a b\n", 3))


# -------------------------------------------------------------------- quality


def test_pooling_does_not_depend_on_blocks(monkeypatch):
    rng = random.Random(6)
    docs = [" ".join(rng.choice(["a", "B!!", "c***", "d", "é"]) for _ in range(rng.choice([0, 1, 2, 50, 400]))).encode() for _ in range(40)]
    sums = np.zeros((quality.BUCKETS, quality.DIM), np.int64)
    quality.add_contexts(sums, *quality.hashed(docs, quality.Words()))
    whole = quality.pooled(docs, sums.astype(float), quality.Words())
    monkeypatch.setattr(quality, "BLOCK", 37)
    again = np.zeros_like(sums)
    quality.add_contexts(again, *quality.hashed(docs, quality.Words()))
    assert (again == sums).all()
    assert np.allclose(quality.pooled(docs, sums.astype(float), quality.Words()), whole)
    assert not whole[[i for i, d in enumerate(docs) if not d]].any()


def test_network_without_both_labels():
    x = np.zeros((4, quality.WIDTH))
    assert 0.5 < quality.fit(x, np.ones(4)).scores(x)[0] < 1
    assert quality.fit(x[:0], np.ones(0)).scores(x)[0] == 0.5


def test_temperature_softens_an_overconfident_network():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, quality.WIDTH))
    y = ((x[:, 0] + rng.normal(size=600)) > 0).astype(float)
    assert quality.fit(x, y).temperature > 1.2


@pytest.mark.parametrize("text", [" " * 300_000, "x" + " " * 100_000 + "y  z", "\n" * 90_000 + " end", "a" + "\u3000" * 80_000, "q \t" * 40_000 + "\t " * 70_000 + "!"])
def test_long_blank_runs_have_the_ids_of_the_pattern(text):
    enc = bpe.encoding(RANKS, P.PATTERN)
    assert bpe.encode_text(enc, text) == enc.encode_ordinary(text)


@pytest.mark.parametrize("unit", [" ", "\n", "\t", "a", "-"])
def test_very_long_runs_do_not_end_the_job(unit):
    enc = bpe.encoding(RANKS, P.PATTERN)
    text = unit * 3_000_000 + "end"
    ids = bpe.encode_text(enc, text)
    assert enc.decode_bytes(ids) == text.encode() and len(ids) < len(text)


_LONG = "This is a long paragraph of the text that has quite a few words and goes on for a while, so that it is dense. " * 3
_TWO = f"<p>{_LONG}</p><p>{_LONG}</p>"


@pytest.mark.parametrize(
    ("page", "more"),
    [
        (f"<body><section><h2>Head</h2><p>Short one.</p></section><section>{_TWO}</section></body>", ["Head", "Short one."]),
        (f"<body><div><div><h1>Title</h1><p>Lead</p></div><div>{_TWO}</div></div><div><a href=x>nav</a></div></body>", ["Title", "Lead"]),
        (f"<body><div>{_TWO}<table><caption>T</caption><tr><td>1</td><td>2</td></tr></table><figure><img><figcaption>Cap</figcaption></figure></div></body>", ["T", "1 2", "Cap"]),
        (f"<body><div>{_TWO}<p>See <a href=x>a page with a long link</a></p><ul><li><a href=q>link</a></li></ul></div></body>", ["See a page with a long link"]),
        (f"<body><div class='content related-layout'>{_TWO}</div><div class=sidebar>side</div></body>", []),
        (f"<body><div id='ad-policy-article'><div class='menu-page'>{_TWO}</div></div></body>", []),
        (f"<body><article class='notice-board'>{_TWO}</article></body>", []),
        (f"<body><form><div>{_TWO}</div><input></form></body>", []),
        (f"<body><div>{_TWO}</div><div class=comments>{_TWO * 9}</div></body>", []),
    ],
)
def test_pages_without_article_keep_their_text(page, more):
    lines = html_text.extract(page).split("\n")
    assert lines.count(_LONG.strip()) == 2 and sorted(x for x in lines if x != _LONG.strip()) == sorted(more)


@pytest.mark.parametrize(
    "page",
    [
        "<b>" * 80_000 + "</i>" * 80_000, "<b>" * 30_000 + "<li></li>" * 30_000, "<b>" * 30_000 + "<svg>" + "<article>x" * 30_000,
        "<b><article>" + "<i>" * 50_000 + "</b>" * 50_000, "<div>x" * 80_000, "<p>" * 150_000, "<div class=menu>x" * 30_000,
    ],
)
def test_time_is_linear_in_unclosed_tags(page):
    start = time.process_time()
    html_text.extract(page)
    assert time.process_time() - start < 30  # quadratic steps take minutes

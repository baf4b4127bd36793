"""Token files, ranked search and zone clusters against brute force, with odd
rows: nulls, empty and long texts, ties, repeated rows, no rows, extra
columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quern.llm import catalog, ranked_search, token_file, zone_clusters
from quern.llm.common import table
from quern.llm.elias_fano import EliasFano, encode
from quern.session import ScratchTables

# ------------------------------------------------------------- token files


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(catalog.TOKENIZER)
    t.encode_special_tokens = True
    return t


@pytest.mark.parametrize(
    "values",
    [
        [], [0], [5], [0, 0, 0, 7, 7, 10**6], list(range(1000)), [0] * 10_000 + [2**64 - 1] * 5, [1 << 57, (1 << 57) + 1],
        sorted(np.random.default_rng(0).integers(0, 2**63, 3000).tolist()),
        sorted(np.random.default_rng(1).integers(0, 50, 50_000).tolist()),
    ],
)
def test_elias_fano_gives_every_value(values):
    data = encode(np.array(values, np.uint64))
    got = EliasFano(data)
    assert len(got) == len(values) and got.get(np.arange(len(values))).tolist() == values
    some = np.random.default_rng(2).integers(0, max(len(values), 1), 20) if values else np.empty(0, int)
    assert got.get(some).tolist() == [values[i] for i in some]


def test_elias_fano_is_small_and_wants_order():
    ends = np.cumsum(np.random.default_rng(3).integers(1, 4000, 100_000)).astype(np.uint64)
    assert len(encode(ends)) * 8 < len(ends) * (2 + math.log2(int(ends[-1]) / len(ends)) + 1)
    with pytest.raises(ValueError):
        encode(np.array([2, 1], np.uint64))


def _ids(encoder, texts):
    return [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(pa.array(texts, pa.string()))]


@pytest.fixture
def encoder():
    with open(catalog.TOKENIZER, "rb") as f:
        return token_file.UnitEncoder(f.read())


def test_units_give_the_ids_of_whole_texts(tokenizer, encoder):
    rng = random.Random(5)
    parts = [" ", "  ", "\n", "\n\n ", "\t", "\r\n", "a", "Zeta", "don't", "'s", "12", "3.5", "!?", "é", "中文", "\u3000", "\xa0", "\x1c", "<|endoftext|>", "x" * 70, "🙂", "\u200b", "\x85"]
    for size in (1, 2, 3, 8, 60):
        for few in (parts, [" a", " the", "b", "!", " 7", "\n", "'s", "\x1c"]):
            texts = ["".join(rng.choice(few) for _ in range(size)) for _ in range(200)]
            for text, got in zip(texts, _ids(encoder, texts), strict=True):
                assert got == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
    assert _ids(encoder, ["", None, " "]) == [[], [], [220]] and _ids(encoder, []) == []


def test_units_forgotten_and_long_runs(tokenizer, encoder, monkeypatch):
    monkeypatch.setattr(token_file, "MAX_UNITS", 3)
    monkeypatch.setattr(token_file, "TOGETHER", 2)
    for text in ["one two three four five six", "two nine ten", "one two", " " * 200_000 + "x", "-" * 100_000, "a\tb " * 40_000, "x\n  y " * 9]:
        assert _ids(encoder, [text]) == [tokenizer.encode(text, add_special_tokens=False).ids]
        assert len(encoder.known) <= 7


def test_other_tokenizers_take_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, "rb") as f:
        encoder = token_file.UnitEncoder(f.read())
    plain = Tokenizer.from_file(path)
    texts = ["One two,  THREE's", "", "É\n x"]
    assert not encoder.cuts and _ids(encoder, texts) == [plain.encode(x, add_special_tokens=False).ids for x in texts]


ODD = [
    (7, "seven <|endoftext|> here", 1), (3, None, 2), (3, "three", 3), (3, "another three", 4), (None, "no id", 5),
    (None, None, 6), (-5, "", 7), (9, " ".join(f"w{i}" for i in range(30_000)), 8), (7, "seven <|endoftext|> here", 1),
    (2**62, "far \n\n off", 9),
]


def _plain(rows, tokenizer):
    """Lengths and digests by id, in the order of the ids."""
    out = []
    for doc_id, text, *_ in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((doc_id, len(ids), zlib.crc32(ids.tobytes())))
    return sorted(out, key=lambda x: (x[0] is not None, x[0] or 0))


@pytest.mark.parametrize(("ids", "docs"), [(1 << 26, 1 << 18), (40, 3)])
def test_token_files_round_trip(spark, tokenizer, ids, docs):
    df = spark.createDataFrame(ODD, "doc_id long, text string, start int").withColumn("path", F.lit(1)).repartition(3)
    path = token_file.write(df, catalog.TOKENIZER, file_ids=ids, file_docs=docs)
    rows = sorted(token_file.read(spark, path, digests=True).collect(), key=lambda r: r.start)
    want = _plain(ODD, tokenizer)
    assert [r.doc_id for r in rows] == [x[0] for x in want]
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
    key = lambda x: (x[0] is not None, *(y or 0 for y in x))
    assert sorted([(r.doc_id, r.n_tokens, r.ids_crc32) for r in rows], key=key) == sorted(want, key=key)
    whole = {(r.doc_id, r.start): r.ids for r in token_file.read(spark, path).collect()}
    assert all(zlib.crc32(np.array(whole[r.doc_id, r.start], "<u4").tobytes()) == r.ids_crc32 for r in rows)


def test_token_files_of_no_rows(spark):
    path = token_file.write(spark.createDataFrame([], "doc_id long, text string"), catalog.TOKENIZER)
    assert token_file.read(spark, path).collect() == []


def test_token_file_query(spark, tokenizer):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    start, want = 0, []
    for doc_id, n, crc in _plain(rows, tokenizer):
        want.append((doc_id, start, n, crc))
        start += n
    got = catalog.op11_token_file(spark, SF_SMALL).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == want


def test_a_file_read_by_position(tmp_path):
    writer = token_file.Writer(str(tmp_path / "a.tok"), np.dtype("<u2"))
    docs = [(None, [1]), (-3, [2, 3]), (-3, []), (8, [4, 5, 6])]
    for doc_id, ids in docs:
        writer.add(doc_id, np.array(ids, "<u2").tobytes())
    writer.close()
    assert np.memmap(tmp_path / "a.tok", "<u2", "r", shape=6).tolist() == [1, 2, 3, 4, 5, 6]
    file = token_file.TokenFile(str(tmp_path / "a.tok"))
    assert file.offsets(0, 4).tolist() == [0, 1, 3, 3, 6] and file.offsets(2, 3).tolist() == [3, 3]
    assert file.doc_ids(0, 4) == [None, -3, -3, 8] and file.doc_ids(2, 4) == [-3, 8]
    assert file.ids(3, 6).tolist() == [4, 5, 6]
    assert [(a, b) for a, b, _ in file.runs(3)] == [(0, 3), (3, 4)]


# ------------------------------------------------------------ ranked search

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def _ranking(docs, items, k):
    bags = [(doc_id, Counter(_TERM.findall(text.translate(_LOWER)))) for doc_id, text in docs if text]
    bags = [(d, b) for d, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item_id, text in sorted({(i, t) for i, t in items if t}, key=str):
        scored = []
        for doc_id, bag in bags:
            m = 50 + 50 * sum(bag.values()) * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 20 * m))
                for t in set(_TERM.findall(text.translate(_LOWER))) if t in bag
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scored)[:k], 1)]
    return out


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x or 0) for x in r))


@pytest.mark.parametrize("query_bytes", [1 << 20, 60])
def test_ranked_search_against_brute_force(spark, query_bytes):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(12)] + ["É", "ünter", "K2", "Don't"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(1, 40)))) for i in range(150)]
    docs += [(5, docs[5][1]), (7, "w1 w2 other"), (None, "w1 w1 K2"), (None, None), (200, None), (201, ""), (202, "-!- \n")]
    docs += [(203, "w3 " * 5000), (204, "w1 w2"), (205, "w2 w1")]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 9)))) for i in range(12)]
    items += [(3, "w1 w2"), (3, "w1 w2"), (50, None), (51, ""), (52, "unknown"), (None, "W4 w5")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("x")).withColumn("score", F.lit(1))
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(1))
    want = _sorted(_ranking(docs, items, 5))
    for segment in (1 << 16, 20):
        got = ranked_search.rank(df.repartition(3), asked, k=5, query_bytes=query_bytes, segment_docs=segment)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert _sorted(map(tuple, got.collect())) == want


def test_ranked_search_without_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert ranked_search.rank(docs, items).collect() == []
    assert ranked_search.rank(table(spark, SF_SMALL, "documents"), items.limit(0)).collect() == []


def test_long_texts_are_cut_between_terms(monkeypatch):
    data = "Alpha béta, GAMMA  x1\n".encode() * 50 + b"z" * 100
    want = [t for x in ranked_search.terms_of(data) for t in x]
    monkeypatch.setattr(ranked_search, "PIECE_BYTES", 17)
    assert [t for x in ranked_search.terms_of(data) for t in x] == want and want[:4] == [b"alpha", "béta".encode(), b"gamma", b"x1"]


def test_accumulators_are_limited_and_survivors_exact():
    rng = np.random.default_rng(4)
    n_docs, n_terms = 3000, 8
    builder = ranked_search.Builder({f"t{i}".encode(): i for i in range(n_terms)})
    texts = [" ".join(f"t{i}" for i in range(n_terms) if rng.random() < 0.9**(n_terms - i) * 0.6 or d < 20) or "none" for d in range(n_docs)]
    for d, text in enumerate(texts):
        builder.add(d, text.encode())
    total = sum(builder.lens)
    row = builder.segment().to_pylist()[0]
    segment = ranked_search.Segment(row, n_docs, total)
    df = Counter(t for x in texts for t in set(x.split()))
    weight = {i: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[f"t{i}"] + 1))) for i in range(n_terms)}
    query = sorted(weight.items(), key=lambda x: (df[f"t{x[0]}"], x[0]))
    found, scores, made = ranked_search.search(segment, query, 10, 0)
    exact = np.zeros(len(segment.ids), np.int64)
    for t, w in query:
        i = segment.terms[t]
        at = slice(segment.ends[i], segment.ends[i + 1])
        exact[segment.docs[at]] += w * segment.shares[at]
    kth = np.sort(exact)[-10]
    assert sorted(found) == np.flatnonzero(exact >= kth).tolist() and (scores == exact[found]).all()
    assert made < (exact > 0).sum()
    floor = int(np.sort(exact)[-3])
    found, scores, fewer = ranked_search.search(segment, query, 10, floor)
    assert fewer <= made and set(np.flatnonzero(exact >= floor)) <= set(found[scores >= floor])


# ------------------------------------------------------------ zone clusters


def _kmeans(rows, k=8, rounds=10, dim=64):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centroids))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for c in range(len(centroids)):
            mine = [v for (_, v), o in zip(kept, own, strict=True) if o == c]
            if mine:
                centroids[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    last = [(i, *near(v)) for i, v in kept]
    inertia = Counter()
    for _, d, c in last:
        inertia[c] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, c, d, inertia[c], sum(inertia.values()), digest[c]) for i, d, c in last]


def _vectors(n, dim=64):
    rng = np.random.default_rng(n)
    centres = rng.normal(0, 1, (5, dim))
    return [(i, [float(np.float32(x)) for x in centres[i % 5] + rng.normal(0, 0.6, dim)]) for i in range(n)]


@pytest.mark.parametrize("block", [256, 4])
def test_zone_clusters_against_brute_force(spark, block):
    rows = _vectors(220)
    rows += [rows[3], rows[3], (900, rows[4][1]), (901, None), (902, [1.0] * 63), (903, [1.0] * 65), (904, [None] + [1.0] * 63)]
    rows += [(905, [float("nan")] * 64), (906, [float("inf")] + [0.0] * 63), (None, rows[9][1]), (907, [0.0] * 64), (908, [-50.25] * 64), (909, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cluster", F.lit("x")).withColumn("place", F.lit(1))
    got = zone_clusters.clusters(df.repartition(3), block=block, rounds=4)
    assert _sorted(map(tuple, got.collect())) == _sorted(_kmeans(rows, rounds=4))


@pytest.mark.parametrize("rows", [[], [(1, [0.5] * 64)], _vectors(5), [(4, [1.0] * 64)] * 9])
def test_zone_clusters_of_few_vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert _sorted(map(tuple, zone_clusters.clusters(df, rounds=2).collect())) == _sorted(_kmeans(rows, rounds=2))


def test_zone_clusters_refuse_components_out_of_range(spark):
    df = spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="64 bits"):
        zone_clusters.clusters(df).collect()


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (5, 2)])
def test_hilbert_places_are_a_path(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
    place = zone_clusters.hilbert(cells, bits)
    assert sorted(place) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(1) == 1).all()


def test_candidates_hold_every_nearest_centroid():
    rng = np.random.default_rng(8)
    for _ in range(300):
        q = rng.integers(-20, 20, (rng.integers(1, 6), 3)) + rng.integers(-30, 30, 3)
        centroids = rng.integers(-40, 40, (5, 3))
        turn = np.linalg.qr(rng.normal(size=(3, 3)))[0]
        y = q @ turn.T
        among = zone_clusters.candidates(y.min(0), y.max(0), centroids @ turn.T)
        own, d = zone_clusters.nearest(q, centroids, among)
        every = ((q[:, None] - centroids) ** 2).sum(2)
        assert (own == every.argmin(1)).all() and (d == every.min(1)).all()


def test_boxes_leave_few_candidates(spark):
    df = spark.createDataFrame(_vectors(3000), "vec_id long, embedding array<float>")
    tables = ScratchTables(spark, "test-zones")
    centres = np.floor(1024 * np.random.default_rng(3000).normal(0, 1, (5, 64))).astype(np.int64)
    of, axes = zone_clusters.blocks(df.select("vec_id", F.col("embedding").alias("v")), tables, 64, 1024, 64)
    rows = [r.asDict() for r in of.collect()]
    left = [len(zone_clusters._among(r, centres @ axes.T)) for r in rows]
    assert sum(r["n"] for r in rows) == 3000 and sum(n == 1 for n in left) > len(left) / 2
    tables.clear()

"""The text operators as Spark jobs: SQL twins, brute force, and tables with
nulls, empty and very long texts, ties, repeated rows, no rows and extra
columns whose names clash."""

import hashlib
import os
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_MID, SF_SMALL
from quern.llm import bpe, catalog, decontam, html_text, license_scan, line_dedup, minhash, quality, repetition, substring_dedup, wordpiece
from quern.llm.common import folded_words, table
from quern.session import ScratchTables
from test_oracle import _canon

LONG = " ".join(f"w{i % 977}x{i // 977}" for i in range(30_000))
ROWS = [
    (1, "One two three four five six seven eight nine ten eleven.\nShared line", "s1", "r", 7),
    (2, None, None, None, None),
    (3, "", "s2", "", 0),
    (None, "A text without an id, but with quite some words in it.", "s3", "r", 1),
    (None, None, None, None, None),
    (4, LONG, "s4", "r", 2),
    (5, "Shared line\n\nReleased under the MIT License.", "s5", "r", 3),
    (5, "Shared line\n\nReleased under the MIT License.", "s5", "r", 3),
    (6, " \n\t\n", "s6", "r", 4),
    (1, "One two three four five six seven eight nine ten eleven.\nShared line", "s7", "q", 8),
]
SCHEMA = "doc_id long, text string, source string, row string, n_chars long"
CLASH = "lines array<string>, spans string, hits int, c string, r1 int, score double, text_ string, first string, drop int"


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    for part in CLASH.split(", "):
        name, kind = part.split(" ")
        docs = docs.withColumn(name, F.lit(None).cast(kind))
    return docs.repartition(3).cache()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "embeddings"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_sql_twin(spark, con, name):
    df = catalog.QUERIES[name](spark, SF_SMALL)
    rel = con.sql(catalog.ORACLES[name])
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(rel.columns, rel.fetchall())


def test_each_operator_has_one_query():
    numbers = [int(n[2:].split("_")[0]) for n in catalog.QUERIES]
    assert sorted(numbers) == list(range(1, 11))


# ------------------------------------------------------------------ odd tables


def test_bpe_on_odd_rows(spark, odd):
    enc = bpe.encoding(bpe.read_ranks(catalog.RANKS), catalog.PATTERN)
    ids = bpe.encode(odd, catalog.RANKS, catalog.PATTERN)
    back = bpe.decode(ids.select(F.col("row.text").alias("text"), "ids"), catalog.RANKS, catalog.PATTERN)
    rows = back.select("row.text", "row.ids", "data").collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert r.ids == enc.encode_ordinary(r.text or "") and bytes(r.data) == (r.text or "").encode()
    assert bpe.encode(odd.limit(0), catalog.RANKS, catalog.PATTERN).count() == 0
    nothing = spark.createDataFrame([(None,)], "ids array<int>")
    assert bpe.decode(nothing, catalog.RANKS, catalog.PATTERN).first().data is None


def test_bpe_query(spark):
    enc = bpe.encoding(bpe.read_ranks(catalog.RANKS), catalog.PATTERN)
    text = {r.doc_id: r.text for r in table(spark, SF_SMALL, "documents").collect()}
    got = catalog.QUERIES["op1_byte_bpe"](spark, SF_SMALL).collect()
    assert {r.doc_id for r in got} == set(text)
    for r in got:
        ids = enc.encode_ordinary(text[r.doc_id])
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(raw).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_license_scan_on_odd_rows(odd):
    got = license_scan.scan(odd).collect()
    assert [(r.doc_id, r.license, r.dice) for r in got] == [(5, "MIT notice", 1.0)] * 2
    assert license_scan.scan(odd.limit(0)).count() == 0
    assert license_scan.scan(odd, templates={"one": "word"}).count() == 0


def test_license_scan_finds_whole_licences(spark):
    full = license_scan.TEMPLATES["MIT"]
    texts = ["Copyright 2020\n\n" + full, full.replace("Software", "Program", 1).replace(" ", "\n", 40), "x " * 30 + "\n" + full.upper()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {(r.doc_id, r.license) for r in license_scan.scan(docs).collect()} == {(0, "MIT"), (1, "MIT"), (2, "MIT")}


def test_license_scan_finds_licences_of_several_paragraphs_inside_a_text(spark):
    mit, gpl = license_scan.TEMPLATES["MIT"], license_scan.TEMPLATES["GPL-3.0 header"]
    for mark in ("subject to the following conditions: ", "Software. THE"):
        mit = mit.replace(mark, mark.replace(": ", ":\r\n\r\n").replace(". ", ".\r\n\r\n"))
    around = "Words of the text around it, which are many. " * 20
    comment = " * " + gpl.replace("\n", "\n * ").replace("version. ", "version.\n *\n * ")
    texts = [
        f"{around}\n\n{mit}\n\n{around}",
        f"/*\n{comment}\n */\n\n{around}",
        f"{around}Released under the MIT\nLicense. {around}",
        around + "\n\n" + around,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {(r.doc_id, r.license, r.dice) for r in license_scan.scan(docs).collect()} == {(0, "MIT", 1.0), (1, "GPL-3.0 header", 1.0), (2, "MIT notice", 1.0)}


def test_license_scan_of_a_text_of_many_blocks(spark):
    """Blocks of other text do not multiply; a licence among them is found."""
    rows = [f"one two w{i}" for i in range(1500)]
    rows[700:700] = license_scan.TEMPLATES["ISC"].split(". ")
    docs = spark.createDataFrame([(1, "\n\n".join([*rows, "Released under the MIT License."]))], "doc_id long, text string")
    got = {(r.doc_id, r.license, r.dice) for r in license_scan.scan(docs).collect()}
    assert got == {(1, "ISC", 1.0), (1, "MIT notice", 1.0)}


def test_license_scan_knows_the_common_licences(spark):
    more = license_scan.MORE
    texts = {
        k: more[k][0] for k in ("BSD-2-Clause", "BSD-3-Clause", "Unlicense", "Apache-2.0", "GPL-2.0", "GPL-3.0", "AGPL-3.0", "LGPL-2.1", "MPL-2.0", "CC0-1.0")
    }
    texts |= {k: more[k][0] for k in ("GPL-2.0 header", "LGPL-2.1 header", "AGPL-3.0 header", "MPL-2.0 header")}
    texts |= {
        "MIT notice": "This project is licensed under the MIT License",
        "CC-BY-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "GPL-2.0 notice": "This work is licensed under the GNU General Public License, version 2.",
        "GPL-3.0 notice": "SPDX-License-Identifier: GPL-3.0-or-later",
    }
    around = "Words that are not of it. " * 9
    docs = spark.createDataFrame([(k, f"{around}\n\n{t}\n\n{around}") for k, t in texts.items()], "doc_id string, text string")
    got = {(r.doc_id, r.license) for r in license_scan.scan(docs).collect() if r.dice > 0.99}
    assert {(k, k) for k in texts} <= got
    assert all(k == x or x.endswith(("notice", "header")) for k, x in got)  # a full text ends with how to apply it


def test_substring_dedup_on_odd_rows(odd):
    assert substring_dedup.spans(odd).count() == 0  # rows that repeat rank alike
    done = substring_dedup.dedup(odd).collect()
    assert len(done) == len(ROWS) and all(r.text == r.row.text and r.spans == [] for r in done)
    assert substring_dedup.spans(odd.limit(0)).count() == 0


def test_repetition_on_odd_rows(odd):
    got = repetition.rules(odd).collect()
    assert len(got) == len(ROWS)
    assert all(r.base_failed and not r.kept for r in got if not r.n_words)
    assert next(r for r in got if r.doc_id == 4).kept
    assert repetition.rules(odd.limit(0)).count() == 0


def test_html_on_odd_rows(spark):
    pages = spark.createDataFrame(
        [(1, "u", None, 1), (None, None, "", 2), (2, "v", "<p>a &amp;</p>", 3), (2, "v", "<p>a &amp;</p>", 3)],
        "page_id long, url string, html string, text int",
    )
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in html_text.main_text(pages).collect())
    assert got == [(0, "", 0), (1, "", 0), (2, "a &", 3), (2, "a &", 3)]
    assert html_text.main_text(pages.limit(0)).count() == 0


def test_decontamination_on_odd_rows(spark, odd):
    items = spark.createDataFrame(
        [(None, "shared line"), (7, None), (8, ""), (9, "one TWO three, four five six seven eight nine ten"), (9, "one two three four five six seven eight nine ten")],
        "item_id long, text string",
    )
    for options in ({}, {"block_bytes": 40}):
        got = decontam.find(odd, items, **options).select("row.doc_id", "text", "items", "spans", F.expr(decontam.N_HIT).alias("n")).collect()
        assert len(got) == len(ROWS)
        by = {r.doc_id: r for r in got}
        assert by[1].items == ["9", "null"] and by[1].n == 12
        assert [by[1].text[s.start : s.end] for s in by[1].spans] == ["One two three four five six seven eight nine ten", "Shared line"]
        assert by[5].items == ["null"] and by[5].n == 2 and by[4].n == by[2].n == by[3].n == 0
    clean = decontam.decontaminate(odd, items)
    assert clean.columns == odd.columns
    texts = {r.doc_id: (r.text, r.n_chars) for r in clean.collect()}
    assert texts[1] == ("\n eleven.\n\n", 11) and texts[2] == (None, None) and texts[4][0] == LONG
    assert decontam.find(odd, items.limit(0)).where("size(hits) > 0").count() == 0
    assert decontam.find(odd.limit(0), items).count() == 0
    whole = spark.createDataFrame([(1, "only this")], "doc_id long, text string")
    assert decontam.decontaminate(whole, spark.createDataFrame([(1, "only this")], "item_id long, text string")).count() == 0


def test_blocks_find_what_one_block_finds(spark, monkeypatch):
    docs, items = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "benchmark")
    docs = docs.withColumn("more", F.create_map(F.lit("a"), F.lit(1)))  # no hash of a map
    docs = docs.unionByName(docs.where("doc_id % 3 = 0")).unionByName(docs.limit(40).withColumn("text", F.lit(None).cast("string")))
    made = []
    build = decontam.phrases_of
    monkeypatch.setattr(decontam, "phrases_of", lambda *a: made.append(1) or build(*a))
    one = decontam.find(docs, items).drop("row")
    windows = items.select(F.sum(F.size(F.split("text", " ")))).first()[0]
    some = decontam.find(docs, items, block_windows=windows // 5)
    assert len(made) > 5 and some.columns == ["row", *one.columns] and some.schema["row"].dataType == docs.schema
    key = lambda df: sorted(map(repr, df.drop("row").collect()))
    assert key(one) == key(some) and one.where("size(hits) > 0").count() > 0


def test_repeated_items_fill_no_block(spark, monkeypatch):
    rows = [(1, "a b c d")] * 300 + [(i, f"w{i} x{i}") for i in range(2, 30)]
    read = []
    monkeypatch.setattr(decontam, "phrases_of", lambda items, window: read.append(items))
    n, parts = decontam.blocks(spark.createDataFrame(rows, "item_id long, text string"), "item_id", "text", 3, 100)
    assert len(list(parts)) == n and sorted(x for part in read for x in part) == sorted(set(rows))


def test_word_pieces_on_odd_rows(odd):
    got = wordpiece.token_counts(odd, ["w", "one"], ["1"]).collect()
    assert len(got) == len(ROWS) and all(r.n_pieces >= r.n_unknown for r in got)
    assert wordpiece.token_counts(odd, [], []).where("n_unknown != n_words OR n_pieces != n_words").count() == 0
    assert wordpiece.token_counts(odd.limit(0), ["a"], []).count() == 0


def test_quality_on_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (5, 1)], "doc_id long, quality int")
    model = quality.train(odd, labels)
    got = quality.score(odd, model).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    empty = quality.train(odd.limit(0), labels.limit(0))
    assert quality.score(odd.limit(0), empty).count() == 0
    assert {r.score for r in quality.score(odd, empty).collect()} == {0.5}


def test_quality_is_held_out(spark):
    got = catalog.QUERIES["op9_quality"](spark, SF_MID).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) for r in got)
    label = {r.doc_id: r.quality for r in table(spark, SF_MID, "labels").collect()}
    held = [(r.predicted, label[r.doc_id]) for r in got if r.held_out and r.doc_id in label]
    assert len(held) > 40 and sum(p == q for p, q in held) / len(held) >= 0.95


def test_quality_does_not_depend_on_partitions(spark):
    docs, labels = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    a, b = (
        {r.row.doc_id: r.score for r in quality.score(d, quality.train(d, labels)).collect()} for d in (docs, docs.repartition(5))
    )
    assert a == pytest.approx(b, abs=1e-6)


def test_line_dedup_on_odd_rows(odd):
    got = line_dedup.dedup(odd, min_sites=3).select("row.doc_id", "row.source", "text", "n_removed").collect()
    assert len(got) == len(ROWS)
    by = {(r.doc_id, r.source): r for r in got}
    assert by[1, "s1"].n_removed == by[1, "s7"].n_removed == 0 and by[5, "s5"].text == "\nReleased under the MIT License."
    assert by[2, None].text is None and by[6, "s6"].text == " \n\t\n"
    clean = line_dedup.clean(odd, min_sites=3)
    assert clean.columns == odd.columns and clean.count() == len(ROWS)
    assert line_dedup.dedup(odd.limit(0)).count() == 0


def test_line_dedup_counts_sites_exactly_near_the_threshold(spark):
    rows = [(100 * n + s, f"line on {n} sites\nown {n} {s}", f"site{s}") for n in range(1, 30) for s in range(n)]
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string, source string")
    got = line_dedup.dedup(docs, min_sites=10).select("row.doc_id", "n_removed").collect()
    assert {r.doc_id for r in got if r.n_removed} == {i for i, *_ in rows if i // 100 >= 10 and i % 100}


# ------------------------------------------------------------------- passages


def test_planted_passages_are_found(spark):
    rng = random.Random(2)
    draw = lambda n: " ".join(f"w{rng.randrange(400)}" for _ in range(n))
    passages = [draw(rng.randint(51, 70)) for _ in range(30)]
    rows, planted = [], defaultdict(list)
    for i in range(160):
        w = draw(rng.randint(5, 120)).split(" ")
        if i % 2 == 0:
            p = rng.choice(passages)
            k = rng.randint(0, len(w))
            w[k:k] = ["É", p.upper() + ","]
            planted[p].append(i)
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    text, found = dict(rows), defaultdict(list)
    for r in substring_dedup.spans(docs).collect():
        found[r.doc_id].append((r.start, r.end, r.kept_doc_id))
    again = {i: (p, ids[0]) for p, ids in planted.items() for i in ids[1:]}
    assert set(found) == set(again)
    for i, (p, first) in again.items():
        ((start, end, kept),) = found[i]
        cut = [w.decode() for w in folded_words(text[i][start:end].encode())]
        assert kept == first and " ".join(cut[1:-1]) in p  # the words beside it may agree by chance
        assert len(cut) >= len(p.split()) - 2 * substring_dedup.WINNOW
    for r in substring_dedup.dedup(docs).collect():
        cut = [(s.start, s.end) for s in r.spans]
        assert cut == sorted((a, b) for a, b, _ in found.get(r.row.doc_id, []))


def test_short_lines_and_paragraphs_are_removed(spark):
    rows = [
        (1, "first own words here\n\nÉine kurze Zeile.\nanother of the first"),
        (2, "* éine KURZE zeile\nsecond own words here"),
        (3, "Éine kurze Zeile. and more of the third"),
        (4, "éine KURZE\nzeile\n\nonly in the fourth\nonly in the fourth"),
        (5, "second own words here"),
    ]
    rows = [(i, t.replace("éine", "Éine")) for i, t in rows]  # other letters than A-Z keep their case
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    text = dict(rows)
    got = sorted((r.doc_id, text[r.doc_id][r.start : r.end], r.kept_doc_id) for r in substring_dedup.spans(docs).collect())
    assert got == [
        (2, "* Éine KURZE zeile", 1),
        (4, "only in the fourth", 4),
        (4, "Éine KURZE\nzeile", 1),
        (5, "second own words here", 2),
    ]


# ------------------------------------------------------------ near duplicates


def _classes(rows, threshold=0.8):
    """Connected components over all pairs."""
    sets, group = {}, {}
    for i, t in rows:
        w = folded_words((t or "").encode())
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    ids = sorted(sets)
    group = {i: i for i in ids}
    for k, i in enumerate(ids):
        for j in ids[:k]:
            shared = len(sets[i] & sets[j])
            if shared and shared >= threshold * (len(sets[i]) + len(sets[j]) - shared) and group[i] != group[j]:
                lo, hi = sorted((group[i], group[j]))
                group = {x: lo if g == hi else g for x, g in group.items()}
    return group


def test_near_duplicates_against_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    got = {r.doc_id: r.class_id for r in catalog.QUERIES["op8_minhash"](spark, SF_SMALL).collect()}
    assert got == _classes(rows)


def test_a_large_group_of_near_copies_keeps_every_link(spark):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(150):
        w = base.copy()
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(80)] = f"n{rng.randrange(10**6) if rng.random() < 0.5 else rng.randrange(3)}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.class_id for r in minhash.classes(docs).collect()}
    expected = _classes(rows)
    assert sum(got[i] != expected[i] for i in got) <= 1 and len(set(expected.values())) > 5  # banding may miss a pair in 10,000
    kept = {r.doc_id for r in minhash.dedup(docs).collect()}
    assert kept == set(got.values())


def test_near_duplicates_meet_whatever_their_counts(spark):
    rows = []
    for i in range(20):
        w = [f"w{i}x{k}" for k in range(204)]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w[:100] + w[20:100] * 40 + w[100:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.class_id for r in minhash.classes(docs).collect()}
    assert got == _classes(rows) == {i: i - i % 2 for i in range(40)}


def test_components_of_hot_nodes(spark):
    rng = random.Random(9)
    pairs = [(0, i) for i in range(1, 400)] + [(900, i) for i in range(500, 900)] + [(399, 450), (450, 451)]
    pairs += [(a, a + 1) for a in range(1000, 1030)] + [tuple(rng.sample(range(1100, 1300), 2)) for _ in range(150)]
    name = lambda i: f"{i:05d}"
    links = spark.createDataFrame([tuple(map(name, rng.sample(p, 2))) for p in pairs], "a string, b string").repartition(5)
    group = {i: i for p in pairs for i in p}
    for a, b in pairs:
        lo, hi = sorted((group[a], group[b]))
        group = {x: lo if g == hi else g for x, g in group.items()}
    got = minhash.components(links, ScratchTables(spark, "test")).collect()
    assert len(got) == len(group) and {r.c: r.comp for r in got} == {name(i): name(g) for i, g in group.items()}


def test_near_duplicates_on_odd_rows(odd):
    got = sorted((r.doc_id or 0, r.class_id or 0) for r in minhash.classes(odd).collect())
    assert got == [(0, 0), (0, 0), (1, 1), (1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (5, 5), (6, 6)]
    kept = minhash.dedup(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 5, 6]
    assert minhash.classes(odd.limit(0)).count() == 0 and minhash.dedup(odd.limit(0)).count() == 0


# ------------------------------------------------------------------- pipeline


def test_pipeline_stages_against_plain_versions(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "decontamination", "encoding"]
    docs = table(spark, SF_SMALL, "documents")
    label = {r.doc_id: r.quality for r in table(spark, SF_SMALL, "labels").collect()}
    item_words = [folded_words(r.text.encode()) for r in table(spark, SF_SMALL, "benchmark").collect()]
    windows = {tuple(w[i : i + min(10, len(w))]) for w in item_words for i in range(max(1, len(w) - 9)) if w}
    before, seen = {r.doc_id: r.asDict() for r in docs.collect()}, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL).cache()
        rows = {r.doc_id: r.asDict() for r in out.collect()}
        assert len(rows) == out.count() and set(rows) <= set(before)
        if name != "encoding":
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "quality":
            gone = set(before) - set(rows)
            assert all(label.get(i) != 1 for i in gone) and sum(label.get(i) == 0 for i in rows) <= 2
            assert all(rows[i] == before[i] for i in rows)
        elif name == "line_dedup":
            assert all({*rows[i]["text"].split("\n")} <= {*before[i]["text"].split("\n")} for i in rows)
        elif name == "near_duplicates":
            classes = _classes([(i, r["text"]) for i, r in before.items()])
            empty = {i for i, r in before.items() if not folded_words(r["text"].encode())}
            assert set(rows) == set(classes.values()) | empty and all(rows[i] == before[i] for i in rows)
        elif name == "decontamination":
            for i, r in rows.items():
                w = folded_words(r["text"].encode())
                hit = any(tuple(w[k : k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w) - n + 1))
                assert not hit and r["n_chars"] == len(r["text"])
        else:
            enc = bpe.encoding(bpe.read_ranks(catalog.RANKS), catalog.PATTERN)
            for i, r in rows.items():
                data = before[i]["text"].encode()
                assert (r["n_bytes"], r["decoded_sha256"]) == (len(data), hashlib.sha256(data).hexdigest())
            assert set(rows) == set(before) and all(r["ids"] == enc.encode_ordinary(before[i]["text"]) for i, r in rows.items())
        docs, before, seen[name] = out, rows, rows
    final = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert final == {i: r["ids"] for i, r in seen["encoding"].items()}


def test_pipeline_tasks_hold_one_python_worker(odd):
    docs = odd.withColumn("lang", F.lit("en"))
    out = corpus_pipeline.encode(odd.sparkSession, docs, SF_SMALL)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    data = [(r.text or "").encode() for r in odd.select("text").collect()]
    assert sorted(r.decoded_sha256 for r in out.collect()) == sorted(hashlib.sha256(x).hexdigest() for x in data)


def test_nothing_else_imports_the_text_operators():
    root = os.path.dirname(corpus_pipeline.__file__)
    for folder, _, names in os.walk(os.path.join(root, "quern")):
        if os.path.basename(folder) != "llm":
            for n in names:
                if n.endswith(".py"):
                    with open(os.path.join(folder, n)) as f:
                        assert "quern.llm" not in f.read()

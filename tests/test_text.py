"""Word statistics: tokenizer and line rules, golden fixture T1, and the
equivalence of the word count variants."""

import re

import pytest

from quern.functions.text import split_lines, tokenize, utf16_length
from quern.operators import text as tx
from quern.sources.text import lines_from_table, read_lines

from conftest import SF_SMALL


def java_split(s):
    if s == "":
        return [""]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def line_source(t):
    if t == "":
        return []
    p = re.split(r"\r\n|\r|\n", t)
    return p[:-1] if t.endswith(("\n", "\r")) else p


T1 = ["a b a", "b  c ", "", "  "]


@pytest.fixture()
def t1(spark):
    return spark.createDataFrame([(i, 0, s) for i, s in enumerate(T1)], "doc_id long, line_no long, line string")


def test_tokenize_matches_java_split(spark):
    cases = T1 + [" a", "a  ", "\ta \t", "x", "  y  z"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(cases)], "i int, s string")
    got = {r.i: list(r.t) for r in df.select("i", tokenize("s").alias("t")).collect()}
    assert got == {i: java_split(s) for i, s in enumerate(cases)}


def test_split_lines_matches_line_source(spark):
    cases = ["", "a", "a\n", "a\r\n", "\n", "\r", "a\rb", "a\r\nb\n", "a\n\n", "\r\n\r\n", "ä\nö", "\n\na"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(cases)], "i int, s string")
    got = {r.i: list(r.l) for r in df.select("i", split_lines("s").alias("l")).collect()}
    assert got == {i: line_source(s) for i, s in enumerate(cases)}


def test_golden_t1(spark, t1):
    counts = {r.word: r.n for r in tx.word_count(t1).collect()}
    assert counts == {"a": 2, "b": 2, "c": 1, "": 2}
    assert tx.distinct_word_count(t1).first().n_words == 4
    assert tx.tokens(t1).count() == 7
    assert tx.avg_distinct_word_length(t1).first().avg_len == pytest.approx(0.75)


def test_doc_term_counts_t1(spark, t1):
    rows = {(r.doc_id, r.word): r.n for r in tx.doc_term_counts(t1).collect()}
    assert rows == {(0, "a"): 2, (0, "b"): 1, (1, "b"): 1, (1, ""): 1, (1, "c"): 1, (2, ""): 1}


def test_utf16_length(spark):
    df = spark.createDataFrame([("a",), ("é",), ("a\U0001F600",), ("",)], "w string")
    assert [r.n for r in df.select(utf16_length("w").alias("n")).collect()] == [1, 1, 3, 0]


def test_variants_agree_on_documents(spark):
    lines = lines_from_table(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    base = sorted(tx.word_count(lines).collect())
    assert base
    for other in (
        tx.word_count_salted(lines, 1),
        tx.word_count_salted(lines, 7, seed=3),
        tx.word_count_from_term_counts(tx.doc_term_counts(lines)),
    ):
        assert sorted(other.collect()) == base
    n_words = tx.distinct_word_count(lines).first().n_words
    assert n_words == len(base) == tx.distinct_words(lines).count()


def test_salts_must_be_positive(spark, t1):
    with pytest.raises(ValueError):
        tx.word_count_salted(t1, 0)


def test_word_count_plan_is_partial_then_final(spark):
    lines = lines_from_table(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    plan = tx.word_count(lines)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "Exchange hashpartitioning(word" in plan
    scan = [l for l in plan.splitlines() if "FileScan parquet" in l][0]
    assert "ReadSchema: struct<text:string>" in scan  # doc_id pruned


def test_read_lines_file(spark, tmp_path):
    p = tmp_path / "docs.txt"
    p.write_text("a b a\nb  c \n\n  \n")
    lines = read_lines(spark, str(p))
    assert sorted(r.line for r in lines.collect()) == sorted(T1)
    assert {r.word: r.n for r in tx.word_count(lines).collect()} == {"a": 2, "b": 2, "c": 1, "": 2}


def test_hot_word_counts_agree(spark):
    # one word holds most tokens: partial aggregation and salting must keep exact counts
    rows = [(i, 0, ("hot " * 50 + f"w{i % 7} cold{i}").strip()) for i in range(400)]
    lines = spark.createDataFrame(rows, "doc_id long, line_no long, line string").repartition(5)
    plain = {r.word: r.n for r in tx.word_count(lines).collect()}
    assert plain["hot"] == 400 * 50 and plain["w0"] == 58 and len(plain) == 1 + 7 + 400
    for salts in (1, 4, 13):
        assert {r.word: r.n for r in tx.word_count_salted(lines, salts, seed=salts).collect()} == plain
    assert {r.word: r.n for r in tx.word_count_from_term_counts(tx.doc_term_counts(lines)).collect()} == plain


def test_counts_inside_the_row_and_one_exchange(spark):
    from quern.plans.catalog import QUERIES, table

    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange ")
    counts = tx.doc_term_counts(lines_from_table(table(spark, SF_SMALL, "documents")))
    assert exchanges(counts) == 0 and exchanges(tx.word_count_from_term_counts(counts)) == 1
    # the catalogue spreads a table of one file, once
    assert exchanges(QUERIES["text_doc_term_counts"](spark, SF_SMALL)) == 1

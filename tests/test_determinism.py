"""Results do not depend on shuffle partition counts or input layout: what
makes task retries and cluster sizes irrelevant to the answers."""

import pytest

from conftest import SF_SMALL
from quern.plans import programs
from quern.plans.catalog import QUERIES

NAMES = ["text_wordcount_salted", "text_doc_term_counts", "vec_seed_bucketed", "vec_kmedian", "num_stable_sample"]


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", NAMES)
def test_same_answer_for_any_shuffle_partitioning(spark, name):
    fn = QUERIES[name]
    base = _rows(fn(spark, SF_SMALL))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        other = _rows(fn(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert other == base and base


@pytest.fixture
def split_size(spark):
    def set_to(value):
        spark.conf.set("spark.sql.files.maxPartitionBytes", value)

    yield set_to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_programs_do_not_follow_the_splits(spark, tmp_path, split_size):
    points = tmp_path / "points"
    points.mkdir()
    for f in range(3):
        (points / f"{f}.txt").write_text("".join(f"{(i * 37 + f) % 101} {(i * i + f) % 89}\n" for i in range(150 + f)))
    docs = tmp_path / "docs.txt"
    docs.write_text("".join(f"w{i % 7} w{i % 5}  x{i}\n" for i in range(400)))
    seen = []
    for size in ("128m", "700b", "97b"):
        split_size(size)
        km = programs.kmedian_program(spark, str(points), 3, 2, 1, seed=5)
        ws = programs.word_statistics(spark, str(docs), 3)
        centres = sorted((r.cid, tuple(round(x, 9) for x in r.c)) for r in km["centres"].collect())
        seen.append((centres, _rows(km["sizes"]), *(_rows(ws[k]) for k in sorted(ws))))
    assert seen[0] == seen[1] == seen[2]


def test_line_numbers_are_those_of_the_files(spark, tmp_path, split_size):
    from quern.sources.layout import numbered_lines

    for name, n in (("a", 50), ("b", 0), ("c", 31)):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}{i}\n" for i in range(n)))
    want = [(i, f"a{i}") for i in range(50)] + [(50 + i, f"c{i}") for i in range(31)]
    for size in ("128m", "40b"):
        split_size(size)
        assert _rows(numbered_lines(spark, str(tmp_path))) == want


@pytest.mark.parametrize(("before", "after"), [("100k", "37k"), ("37k", "100k"), ("128m", "9k")])
def test_no_line_is_lost_when_splits_change_before_the_action(spark, tmp_path, split_size, before, after):
    from quern.sources.text import read_lines
    from quern.sources.vectors import read_points

    (tmp_path / "lines.txt").write_text("".join(f"{i} {i * 7 % 1000}\n" for i in range(20_000)))
    split_size(before)
    lines, points = read_lines(spark, str(tmp_path)), read_points(spark, str(tmp_path))
    split_size(after)
    spark.conf.set("spark.sql.files.minPartitionNum", "11")
    try:
        want = [(i, f"{i} {i * 7 % 1000}") for i in range(20_000)]
        assert _rows(lines.select("doc_id", "line")) == want
        assert _rows(points.selectExpr("id", "p[0]", "p[1]")) == [(i, float(i), float(i * 7 % 1000)) for i in range(20_000)]
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_a_table_of_few_files_is_spread(spark, tmp_path):
    from quern.sources.text import lines_from_table

    rows = spark.createDataFrame([(i, f"a{i}\nb") for i in range(50)], "doc_id long, text string")
    rows.repartition(1).write.parquet(str(tmp_path / "one"))
    rows.repartition(6).write.parquet(str(tmp_path / "six"))
    one, six = (spark.read.parquet(str(tmp_path / n)) for n in ("one", "six"))
    assert "Exchange" in lines_from_table(one, partitions=4)._jdf.queryExecution().toString()
    assert "Exchange" not in lines_from_table(six, partitions=4)._jdf.queryExecution().toString()
    assert _rows(lines_from_table(one, partitions=4)) == _rows(lines_from_table(six)) and lines_from_table(one, partitions=4).count() == 100

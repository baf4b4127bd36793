"""Numeric column statistics: golden fixture N1, edge cases N2, sampling."""

import math

import pytest
from pyspark.sql import functions as F

from quern.operators import numeric as num
from quern.sources.numbers import numbers_from_text, read_numbers


@pytest.fixture()
def n1(spark, tmp_path):
    p = tmp_path / "numbers.txt"
    p.write_text("".join(f"{i}.0\n" for i in range(1, 11)) + "\n")
    return read_numbers(spark, str(p))


def test_read_numbers_file(n1):
    assert sorted(r.x for r in n1.collect()) == [float(i) for i in range(1, 11)]


def test_read_numbers_any_whitespace(spark, tmp_path):
    p = tmp_path / "ws.txt"
    p.write_text("1 2\t3\n\n  4.5   1e2\n")
    assert sorted(r.x for r in read_numbers(spark, str(p)).collect()) == [1, 2, 3, 4.5, 100]


def test_read_numbers_bad_token_fails(spark, tmp_path):
    p = tmp_path / "bad.txt"
    p.write_text("1 two 3\n")
    with pytest.raises(Exception):
        read_numbers(spark, str(p)).collect()


def test_numbers_from_text_positions(spark):
    df = spark.createDataFrame([(1, " 3 \t 4.5 "), (2, "")], "k long, t string")
    rows = sorted((r.k, r.pos, r.x) for r in numbers_from_text(df, "t", keep=("k",)).collect())
    assert rows == [(1, 0, 3.0), (1, 1, 4.5)]


def test_golden_n1(n1):
    st = num.column_stats(n1, "x").first()
    assert (st.n, st.mx, st.mn, st.mean) == (10, 10.0, 1.0, 5.5)
    z = sorted(r.z for r in num.minmax_scale(n1, "x").collect())
    assert z == pytest.approx([(i - 1) / 9 for i in range(1, 11)])
    assert sum(z) / len(z) == pytest.approx(0.5)
    below = sorted(r.z for r in num.below_mean(n1, "x").collect())
    assert below == pytest.approx([0, 1 / 9, 2 / 9, 3 / 9, 4 / 9])


def test_empty_column(spark):
    df = spark.createDataFrame([], "x double")
    st = num.column_stats(df, "x").first()
    assert st.n == 0 and st.mx is None and st.mn is None and st.mean is None
    assert num.minmax_scale(df, "x").count() == 0
    assert num.below_mean(df, "x").count() == 0


def test_constant_column(spark):
    df = spark.createDataFrame([(7.0,), (7.0,)], "x double")
    assert [r.z for r in num.minmax_scale(df, "x").collect()] == [None, None]
    assert num.below_mean(df, "x").count() == 0


def test_nan_and_null_are_left_out(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "x double")
    st = num.column_stats(df, "x").first()
    assert (st.n, st.mx, st.mn) == (2, 3.0, 1.0)
    assert sorted(r.z for r in num.minmax_scale(df, "x").collect()) == [0.0, 1.0]
    assert [r.x for r in num.below_mean(df, "x").collect()] == [1.0]


def test_max_two_ways(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).cast("double").alias("x"))
    a = df.agg(F.max("x")).first()[0]
    b = num.column_stats(df, "x").first().mx
    assert a == b == 999.0


def test_stable_sample_ignores_layout(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    a = {r.k for r in num.stable_sample(df, "k", 0.3, 7).collect()}
    b = {r.k for r in num.stable_sample(df.repartition(13), "k", 0.3, 7).collect()}
    assert a == b
    n, p = 20000, 0.3
    assert abs(len(a) - n * p) < 5 * math.sqrt(n * p * (1 - p))


def test_bernoulli_sample_size(spark):
    df = spark.range(20000)
    k = num.bernoulli_sample(df, 0.5, 11).count()
    assert abs(k - 10000) < 5 * math.sqrt(20000 * 0.25)


def test_fraction_checked(spark):
    with pytest.raises(ValueError):
        num.stable_sample(spark.range(3), "id", 1.5, 1)


def test_read_numbers_directory_with_hint(spark, tmp_path):
    d = tmp_path / "nums"
    d.mkdir()
    (d / "a.txt").write_text("1 2\n")
    (d / "b.txt").write_text("3\n\n4\n")
    df = read_numbers(spark, str(d), partitions=4)
    assert sorted(r.x for r in df.collect()) == [1.0, 2.0, 3.0, 4.0]


@pytest.mark.parametrize("values", [[0.1, 0.2, 0.3], [0.1, 0.3, 0.5], [1.0, 2.0, float("inf")], [3.0, 3.0], [1.0]])
def test_below_mean_compares_scaled_values(spark, values):
    # the rule over Python floats, in list order
    lo, hi = min(values), max(values)
    z = [(x - lo) / (hi - lo) for x in values] if hi > lo else []
    mean = sum(z) / len(z) if z else 0.0
    want = sorted(v for v in z if v < mean)
    df = spark.createDataFrame([(x,) for x in values], "x double").coalesce(1)
    assert sorted(r.z for r in num.below_mean(df, "x").collect()) == want


def test_sample_size_and_facts_over_seeds(spark):
    df = spark.range(2000).withColumn("x", F.col("id").cast("double"))
    for seed in range(12):
        s = num.bernoulli_sample(df, 0.3, seed)
        assert abs(s.count() - 600) < 5 * (2000 * 0.3 * 0.7) ** 0.5
        assert tuple(num.sample_facts(df, s, "id").first()) == (2000, 0, 0)
    strange = spark.createDataFrame([(5,), (5,), (9999,)], "id long")
    assert tuple(num.sample_facts(df, strange, "id").first()) == (2000, 1, 1)
    assert tuple(num.sample_facts(df.limit(0), df.limit(0), "id").first()) == (0, 0, 0)

"""Property tests (hypothesis), few examples each: every example is a
handful of Spark jobs."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quern.operators import clustering as cl
from quern.operators import numeric as num
from quern.operators import text as tx

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

finite = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False)


@SETTINGS
@given(st.lists(finite, min_size=2, max_size=40))
def test_scaled_values_in_unit_interval(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    z = [r.z for r in num.minmax_scale(df, "x").collect()]
    if max(xs) == min(xs):
        assert all(v is None for v in z)
    else:
        assert min(z) == 0.0 and max(z) == 1.0 and all(0.0 <= v <= 1.0 for v in z)
        below = num.below_mean(df, "x").count()
        mean = sum(xs) / len(xs)
        assert below == sum(1 for x in xs if x < mean) or abs(min(abs(x - mean) for x in xs)) < 1e-6


def java_split(s):
    if s == "":
        return [""]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


line = st.text(alphabet=st.sampled_from(["a", "b", "é", " ", "x"]), max_size=12)


@SETTINGS
@given(st.lists(line, min_size=1, max_size=12))
def test_word_count_matches_java_split(spark, lines):
    df = spark.createDataFrame([(i, 0, s) for i, s in enumerate(lines)], "doc_id long, line_no long, line string")
    expect = Counter(w for s in lines for w in java_split(s))
    assert {r.word: r.n for r in tx.word_count(df).collect()} == dict(expect)
    assert {r.word: r.n for r in tx.word_count_salted(df, 3).collect()} == dict(expect)
    avg = tx.avg_distinct_word_length(df).first().avg_len
    if expect:
        assert avg == pytest.approx(sum(len(w) for w in expect) / len(expect))
    else:
        assert avg is None


points = st.lists(st.tuples(st.integers(-5, 5), st.integers(-5, 5)), min_size=3, max_size=25)


@SETTINGS
@given(points, st.integers(1, 4))
def test_assignment_is_nearest(spark, pts, k):
    df = spark.createDataFrame([(i, [float(a), float(b)]) for i, (a, b) in enumerate(pts)], "id long, p array<double>")
    cs = cl.first_centres(df, k)
    C = np.array([r.c for r in cs.orderBy("cid").collect()])
    for r in cl.assign_nearest(df, cs).collect():
        d = np.sqrt(((C - np.array(r.p)) ** 2).sum(axis=1))
        assert r.d == pytest.approx(d.min())
        assert r.cid == int(np.flatnonzero(np.isclose(d, d.min()))[0])


@SETTINGS
@given(points, st.integers(1, 3), st.integers(1, 3))
def test_coreset_weights_and_layout_independence(spark, pts, k, buckets):
    rows = [(i, [float(a), float(b)]) for i, (a, b) in enumerate(pts)]
    df = spark.createDataFrame(rows, "id long, p array<double>")
    core = sorted((r.bucket, r.cid, r.w, tuple(r.c)) for r in cl.coreset(df, k, buckets, 1, seed=4).collect())
    assert sum(c[2] for c in core) == len(pts)
    again = sorted(
        (r.bucket, r.cid, r.w, tuple(r.c)) for r in cl.coreset(df.repartition(3), k, buckets, 1, seed=4).collect()
    )
    assert again == core
    distinct_per_bucket = {}
    for b, (i, p) in zip([r.bucket for r in cl.prepare_points(df, buckets, 4).orderBy("id").collect()], rows):
        distinct_per_bucket.setdefault(b, set()).add(tuple(p))
    for b, cids in Counter(c[0] for c in core).items():
        assert cids <= min(k, len(distinct_per_bucket[b]))


def line_source(t):
    import re

    if t == "":
        return []
    parts = re.split(r"\r\n|\r|\n", t)
    return parts[:-1] if t.endswith(("\n", "\r")) else parts


@SETTINGS
@given(st.lists(st.text(alphabet=st.sampled_from(["a", " ", "\n", "\r", "é"]), max_size=15), min_size=1, max_size=15))
def test_split_lines_matches_line_source(spark, texts):
    from quern.functions.text import split_lines

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: list(r.l) for r in df.select("i", split_lines("t").alias("l")).collect()}
    assert got == {i: line_source(t) for i, t in enumerate(texts)}


def test_keyed_uniform_equals_duckdb_twin(spark):
    import duckdb

    from quern.functions.random import keyed_uniform, keyed_uniform_sql

    ids = [0, 1, -1, 7, 123456789, -987654321, 9223372036854775807, -9223372036854775808]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    got = {r.id: r.u for r in df.select("id", keyed_uniform(42, "coreset:3", "id").alias("u")).collect()}
    con = duckdb.connect()
    rows = con.sql(
        "SELECT id, " + keyed_uniform_sql(42, "coreset:3", "id") + " AS u FROM (SELECT unnest(?::BIGINT[]) AS id)",
        params=[ids],
    ).fetchall()
    assert got == dict(rows)
    assert all(0.0 < u < 1.0 for u in got.values())

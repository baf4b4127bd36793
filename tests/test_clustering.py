"""Vectors and clustering: golden fixtures V1-V5, seeding rules, coreset
and k-median properties, the race draw distribution."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.functions.random import keyed_uniform
from quern.operators import clustering as cl
from quern.sources.vectors import parse_vector, points_from_embeddings, read_points

from conftest import SF_SMALL


def pts_df(spark, vecs, weights=None):
    rows = [(i, [float(x) for x in v], (weights[i] if weights else 1)) for i, v in enumerate(vecs)]
    return spark.createDataFrame(rows, "id long, p array<double>, w long")


def centres_df(spark, vecs):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)], "cid int, c array<double>")


V1 = [[0], [1], [10], [11]]


def test_v1_assign_objective_weights(spark):
    p, c = pts_df(spark, V1), centres_df(spark, [[0], [10]])
    a = {r.id: (r.cid, r.d) for r in cl.assign_nearest(p, c).collect()}
    assert a == {0: (0, 0.0), 1: (0, 1.0), 2: (1, 0.0), 3: (1, 1.0)}
    assert cl.objective(p, c).first().objective == pytest.approx(0.5)
    assert {r.cid: r.w for r in cl.cluster_weights(p, c).collect()} == {0: 2, 1: 2}


def test_v1_centroid_update(spark):
    c = centres_df(spark, [[0], [10]])
    new = {r.cid: list(r.c) for r in cl.centroid_update(pts_df(spark, V1), c).collect()}
    assert new == {0: [0.5], 1: [10.5]}
    wp = pts_df(spark, V1, [1, 3, 1, 1])
    new = {r.cid: list(r.c) for r in cl.centroid_update(wp, c, "w").collect()}
    assert new == {0: [0.75], 1: [10.5]}


def test_v2_tie_goes_to_lowest_cid(spark):
    a = cl.assign_nearest(pts_df(spark, [[5]]), centres_df(spark, [[0], [10]])).first()
    assert (a.cid, a.d) == (0, 5.0)


def test_v3_empty_cluster_keeps_centre(spark):
    c = centres_df(spark, [[0], [10], [100]])
    new = {r.cid: list(r.c) for r in cl.lloyd(pts_df(spark, V1), c, 1).collect()}
    assert new == {0: [0.5], 1: [10.5], 2: [100.0]}
    assert 2 not in {r.cid for r in cl.cluster_weights(pts_df(spark, V1), c).collect()}


def test_v4_duplicates_give_one_centre(spark):
    s = cl.seed_centres(pts_df(spark, [[3, 3]] * 3), 2, seed=1)
    assert s.count() == 1


def test_v5_mixed_dimensions_fail(spark):
    p = pts_df(spark, [[1, 2], [1]])
    with pytest.raises(Exception, match="dimension"):
        cl.assign_nearest(p, centres_df(spark, [[1, 2]])).collect()


def test_parameters_checked(spark):
    p = pts_df(spark, V1)
    for bad in (lambda: cl.seed_centres(p, 0), lambda: cl.coreset(p, 2, 0, 1), lambda: cl.lloyd(p, centres_df(spark, [[0]]), -1)):
        with pytest.raises(ValueError):
            bad()


def test_seeding_distinct_points_and_order(spark):
    p = pts_df(spark, [[i, i % 3] for i in range(30)])
    s = cl.seed_centres(p, 5, seed=9).collect()
    assert sorted(r.cid for r in s) == list(range(5))
    assert len({r.id for r in s}) == 5
    again = cl.seed_centres(p.repartition(5), 5, seed=9).collect()
    assert sorted((r.cid, r.id) for r in s) == sorted((r.cid, r.id) for r in again)


def test_bucketed_seeding_stops_early_per_bucket(spark):
    # 6 points; with 4 buckets some bucket holds fewer than k points
    p = pts_df(spark, [[i] for i in range(6)])
    s = cl.seed_centres(p, 3, seed=2, n_buckets=4).collect()
    per = {}
    for r in s:
        per.setdefault(r.bucket, []).append(r.cid)
    bucket = {r.id: r.bucket for r in cl.prepare_points(p, 4, 2).collect()}
    sizes = {b: sum(1 for v in bucket.values() if v == b) for b in set(bucket.values())}
    for b, cids in per.items():
        assert sorted(cids) == list(range(min(3, sizes[b])))


def test_race_draw_distribution(spark):
    # 4 candidates with w*d = 1, 2, 3, 4: pick frequencies over many seeds
    n_seeds = 4000
    cand = spark.range(4).select(F.col("id"), (F.col("id") + 1).cast("double").alias("wd"))
    seeds = spark.range(n_seeds).withColumnRenamed("id", "s")
    key = -F.ln(keyed_uniform("s", "race", "id")) / F.col("wd")
    picks = seeds.crossJoin(cand).groupBy("s").agg(F.min_by("id", key).alias("pick"))
    counts = {r.pick: r.n for r in picks.groupBy("pick").agg(F.count("*").alias("n")).collect()}
    exp = {i: n_seeds * (i + 1) / 10 for i in range(4)}
    chi2 = sum((counts.get(i, 0) - e) ** 2 / e for i, e in exp.items())
    assert chi2 < 16.27  # p = 0.001, 3 degrees of freedom


def test_coreset_weights_sum_to_n(spark):
    p = points_from_embeddings(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"))
    core = cl.coreset(p, 3, 4, 1, seed=5).collect()
    assert sum(r.w for r in core) == 500
    assert all(r.w > 0 for r in core)
    assert len(core) <= 12


def test_kmedian_partition_independent(spark):
    p = points_from_embeddings(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"))
    a = sorted((r.cid, tuple(round(x, 9) for x in r.c)) for r in cl.kmedian(p, 3, 4, 1, 7).collect())
    b = sorted((r.cid, tuple(round(x, 9) for x in r.c)) for r in cl.kmedian(p.repartition(6), 3, 4, 1, 7).collect())
    assert a == b and len(a) == 3


def test_assignment_is_nearest_and_objective_properties(spark):
    p = points_from_embeddings(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"))
    cs = cl.first_centres(p, 4)
    C = np.array([r.c for r in cs.orderBy("cid").collect()])
    rows = cl.assign_nearest(p, cs).collect()
    for r in rows[:200]:
        d = np.sqrt(((C - np.array(r.p)) ** 2).sum(axis=1))
        assert r.d == pytest.approx(d.min()) and r.cid == int(np.argmin(d))
    obj4 = cl.objective(p, cs).first().objective
    obj5 = cl.objective(p, cl.first_centres(p, 5)).first().objective
    assert obj5 <= obj4 + 1e-12
    # one Lloyd round never raises the squared cost
    def sq_cost(centres):
        a = cl.assign_nearest(p, centres)
        return a.agg(F.sum(F.col("d") * F.col("d"))).first()[0]
    assert sq_cost(cl.lloyd(p, cs, 1)) <= sq_cost(cs) + 1e-9


def test_kmedian_direct_and_objective(spark):
    p = points_from_embeddings(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"))
    c = cl.kmedian_direct(p, 3, 2, seed=1)
    assert c.count() == 3
    obj = cl.objective(p, c).first().objective
    assert 0 < obj < 2


def test_read_points_file(spark, tmp_path):
    f = tmp_path / "pts.txt"
    f.write_text("0 0\n1 0\n10 0 \n11 0\n")
    p = read_points(spark, str(f))
    assert sorted(tuple(r.p) for r in p.collect()) == [(0, 0), (1, 0), (10, 0), (11, 0)]
    c = cl.kmedian_direct(p, 2, 2, seed=3)
    assert sorted(tuple(r.c) for r in c.collect()) == [(0.5, 0.0), (10.5, 0.0)]


def test_parse_vector_bad_token(spark):
    df = spark.createDataFrame([("1 x",)], "t string")
    with pytest.raises(Exception):
        df.select(parse_vector("t")).collect()


@pytest.fixture
def threshold(spark):
    """Sets the broadcast threshold for one test."""

    def set_to(value):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", value)

    yield set_to
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("limit", ["10m", "600", "-1"])
def test_model_in_blocks_of_rows(spark, threshold, monkeypatch, limit):
    # sparse ids: blocks are cut by position, not by id range
    p = pts_df(spark, [[i % 7, i % 3] for i in range(40)])
    ids = [0, 3, 7, 8, 9, 1000, 1001, 5000, 10**6, 10**6 + 1, 2 * 10**6, 2 * 10**9]
    c = spark.createDataFrame([(cid, [float(i % 5), float(i % 4)]) for i, cid in enumerate(ids)], "cid int, c array<double>")
    whole = sorted((r.id, r.cid, r.d) for r in cl.assign_nearest(p, c).collect())
    monkeypatch.setattr(cl, "BLOCK_ROWS", 3)
    monkeypatch.setattr(cl, "BLOCKS_IN_PLAN", 2)  # the best so far is written on the way
    layout = cl._layout(p, 1, len(ids), 2)
    sizes = [r.n for r in cl._lists(cl._one_bucket(c), layout).selectExpr("size(cs) AS n").collect()]
    assert layout.blocks == 4 and sizes == [3] * 4
    threshold(limit)
    df = cl.assign_nearest(p, c)
    assert sorted((r.id, r.cid, r.d) for r in df.collect()) == whole
    assert "CartesianProduct" not in plan_of(df)


def test_no_broadcast_beyond_the_threshold(spark, threshold):
    p = points_from_embeddings(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"))
    c = cl.first_centres(p, 5).select("cid", "c").cache()
    run = lambda: (
        sorted((r.cid, tuple(round(x, 9) for x in r.c)) for r in cl.lloyd(p, c, 1).collect()),
        sorted((r.cid, tuple(round(x, 9) for x in r.c)) for r in cl.kmedian_direct(p, 3, 1, seed=2).collect()),
        sorted((r.bucket, r.cid, r.w) for r in cl.coreset(p, 3, 2, 1, seed=8).collect()),
        sorted((r.bucket, r.cid, r.w) for r in cl.coreset(p, 3, 9, 1, seed=8).collect()),
        sorted((r.bucket, r.cid, r.id) for r in cl.seed_centres(p, 10, seed=3, n_buckets=2).collect()),
    )
    want = run()
    threshold("-1")
    assert "Broadcast" not in plan_of(cl.assign_nearest(p, c))
    assert run() == want
    layout = cl._layout(p, 2, 3, 64)
    assert layout.salts >= 4  # a bucket is spread over tasks
    threshold("1t")
    assert cl._layout(p, 2, 3, 64).salts == 0


@pytest.mark.parametrize("bad", [-1.0, float("nan"), float("inf"), None])
def test_bad_weights_fail(spark, bad):
    p = spark.createDataFrame([(0, [0.0], 1.0), (1, [2.0], bad)], "id long, p array<double>, w double")
    with pytest.raises(Exception, match="weight"):
        cl.centroid_update(p, centres_df(spark, [[0]]), "w").collect()


def test_fractional_and_zero_weights_count(spark):
    rows = [(0, [0.0], 0.5), (1, [1.0], 1.5), (2, [7.0], 0.0)]
    p = spark.createDataFrame(rows, "id long, p array<double>, w double")
    c = centres_df(spark, [[0], [100]])
    assert {r.cid: list(r.c) for r in cl.centroid_update(p, c, "w").collect()} == {0: [0.75], 1: [100.0]}
    assert [(r.cid, r.w) for r in cl.cluster_weights(p, c, "w").collect()] == [(0, 2.0)]
    assert sorted((r.cid, r.w) for r in cl.cluster_sizes(p, c, "w").collect()) == [(0, 2.0), (1, 0.0)]
    # the first centre is drawn without regard to weights, the others never at weight 0
    firsts, others = set(), set()
    for seed in range(12):
        for r in cl.seed_centres(p, 3, seed=seed, weight_col="w").collect():
            (firsts if r.cid == 0 else others).add(r.id)
    assert 2 in firsts and 2 not in others


def test_spread_keeps_rows(spark):
    from quern.sources.layout import spread

    df = spark.range(1000).coalesce(1)
    s = spread(df, 7)
    assert s.rdd.getNumPartitions() == 7
    assert sorted(r.id for r in s.collect()) == list(range(1000))


def test_nearest_centre_is_computed_once(spark):
    p = points_from_embeddings(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"))
    c = spark.createDataFrame([(0, [0.0] * 64), (1, [1.0] * 64)], "cid int, c array<double>")
    assert plan_of(cl.cluster_sizes(p, c)).count("array_min(transform(") == 1


def _files(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, fs in os.walk(root) for f in fs if f.startswith("part-"))


def test_only_the_result_stays_on_disk(spark):
    from quern.session import checkpoint_root

    root = checkpoint_root(spark).removeprefix("file:")
    p = points_from_embeddings(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"))
    before = set(_files(root))
    df = cl.seed_centres(p, 10, seed=3)
    left = {os.path.dirname(f) for f in set(_files(root)) - before}
    assert len(left) == 1 and df.count() == 10
    before = set(_files(root))
    df = cl.kmedian(p, 3, 4, 1, seed=3)
    left = {os.path.dirname(f) for f in set(_files(root)) - before}
    assert len(left) == 1 and df.count() == 3


@pytest.mark.parametrize("k", [8, 20])
def test_long_seeding_matches_oracle_through_refreshes(spark, k):
    # the frame of points and distances is written every REFRESH rounds
    import duckdb

    from quern.plans import oracle as orc

    p = points_from_embeddings(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"))
    got = sorted((r.bucket, r.cid, r.id) for r in cl.seed_centres(p, k, seed=42, n_buckets=2).collect())
    sql = orc._with([orc._PTS, orc._prepared(2)] + orc._seed_ctes("prep", k, "seed", "seeds"),
                    "SELECT bucket, cid, id FROM seeds")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF_SMALL}/embeddings.parquet')")
    assert got == sorted(con.sql(sql).fetchall())
    assert len(got) == 2 * k


def test_read_points_directory_and_hint(spark, tmp_path):
    d = tmp_path / "pts"
    d.mkdir()
    (d / "a.txt").write_text("0 0\n1 0\n")
    (d / "b.txt").write_text("10 0\n11 0\n")
    p = read_points(spark, str(d), partitions=3)
    assert p.rdd.getNumPartitions() == 3
    rows = p.collect()
    assert len({r.id for r in rows}) == 4
    assert sorted(tuple(r.p) for r in rows) == [(0, 0), (1, 0), (10, 0), (11, 0)]


def test_empty_point_set(spark):
    p = spark.createDataFrame([], "id long, p array<double>")
    assert cl.seed_centres(p, 3, seed=1).count() == 0
    assert cl.coreset(p, 3, 2, 1, seed=1).count() == 0
    c = cl.kmedian(p, 3, 2, 1, seed=1)
    assert c.count() == 0
    assert cl.objective(p, c).first().objective is None
    q = pts_df(spark, V1)
    a = cl.assign_nearest(q, c).collect()
    assert [r.cid for r in a] == [None] * 4

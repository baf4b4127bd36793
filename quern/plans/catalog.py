"""The query catalogue: each operator bound to the driver's tables.

Every entry is ``(spark, sf_dir) -> DataFrame`` over whole tables. Output
columns are aliased, integers are BIGINT and doubles that depend on
summation order are rounded to 6 places, so results compare with the DuckDB
oracle in ``quern.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.text import split_lines
from quern.functions.vectors import euclidean, sqdist
from quern.operators import clustering as cl
from quern.operators import numeric as num
from quern.operators import text as tx
from quern.session import ScratchTables
from quern.sources.numbers import numbers_from_text
from quern.sources.text import lines_from_table
from quern.sources.vectors import parse_vector, points_from_embeddings

# Fixed query parameters (shared with the oracle SQL).
SEED = 42
SAMPLE_FRACTION = 0.5
SALTS = 8
K_FIXED = 5  # centres = the K_FIXED points with the smallest ids
K = 3
BUCKETS = 4
ITERS = 1
LLOYD_ROUNDS = 2
DIGITS = 6

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _r(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, DIGITS)


def _long(name: str) -> Column:
    return F.col(name).cast("long").alias(name)


# ------------------------------------------------------------------ numeric


def num_max_min(spark, sf_dir):
    s = num.column_stats(table(spark, sf_dir, "lineitem"), "l_extendedprice")
    return s.select("mx", "mn")


def num_mean(spark, sf_dir):
    s = num.column_stats(table(spark, sf_dir, "events"), "value")
    return s.select(_r("mean").alias("mean_value"))


def num_count(spark, sf_dir):
    s = num.column_stats(table(spark, sf_dir, "events"), "value")
    return s.select(F.col("n").cast("long").alias("n"))


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "value")


def num_minmax_scale(spark, sf_dir):
    z = num.minmax_scale(_events(spark, sf_dir), "value")
    return z.select("event_id", _r("z").alias("z"))


def num_below_mean(spark, sf_dir):
    z = num.below_mean(_events(spark, sf_dir), "value")
    return z.select("event_id", _r("z").alias("z"))


def num_stable_sample(spark, sf_dir):
    z = num.minmax_scale(_events(spark, sf_dir), "value")
    s = num.stable_sample(z, "event_id", SAMPLE_FRACTION, SEED)
    return s.select("event_id", _r("z").alias("z"))


def num_bernoulli_sample(spark, sf_dir):
    """The sampler is Spark's own and follows the partitions, so the query
    reports what holds for any of them."""
    z = num.minmax_scale(_events(spark, sf_dir), "value")
    return num.sample_facts(z, num.bernoulli_sample(z, SAMPLE_FRACTION, SEED), "event_id")


def parse_numbers(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    text = F.concat_ws(" \t ", F.col("p_size").cast("string"), F.col("p_retailprice").cast("string"))
    rendered = part.select("p_partkey", text.alias("text"))
    return numbers_from_text(rendered, "text", keep=("p_partkey",))


# ------------------------------------------------------------------ text


def _lines(spark, sf_dir):
    cores = spark.sparkContext.defaultParallelism
    return lines_from_table(table(spark, sf_dir, "documents"), "doc_id", "text", partitions=cores)


def text_lines(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.size(split_lines(F.col("text"))).cast("long").alias("n_lines"))


def text_doc_term_counts(spark, sf_dir):
    return tx.doc_term_counts(_lines(spark, sf_dir))


def text_wordcount(spark, sf_dir):
    return tx.word_count(_lines(spark, sf_dir))


def text_wordcount_salted(spark, sf_dir):
    return tx.word_count_salted(_lines(spark, sf_dir), SALTS, SEED)


def text_wordcount_preagg(spark, sf_dir):
    return tx.word_count_from_term_counts(tx.doc_term_counts(_lines(spark, sf_dir)))


def text_distinct_words(spark, sf_dir):
    return tx.distinct_words(_lines(spark, sf_dir))


def text_distinct_count(spark, sf_dir):
    return tx.distinct_word_count(_lines(spark, sf_dir))


def text_avg_word_length(spark, sf_dir):
    return tx.avg_distinct_word_length(_lines(spark, sf_dir)).select(_r("avg_len").alias("avg_len"))


# ------------------------------------------------------------------ vectors


def _points(spark, sf_dir):
    return points_from_embeddings(table(spark, sf_dir, "embeddings"))


def _explode_centres(centres: DataFrame, *keys: str) -> DataFrame:
    return centres.select(*keys, F.posexplode("c").alias("pos", "v")).select(
        *[_long(k) for k in keys], F.col("pos").cast("long").alias("pos"), _r("v").alias("v")
    )


def parse_vectors(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    text = F.array_join(F.transform("embedding", lambda x: x.cast("double").cast("string")), " ")
    pts = emb.select(F.col("vec_id"), parse_vector(text).alias("p"))
    return pts.select(
        "vec_id",
        F.size("p").cast("long").alias("dim"),
        F.col("p")[0].alias("first"),
        _r(F.aggregate("p", F.lit(0.0), lambda acc, x: acc + x * x)).alias("sumsq"),
    )


def vec_distance(spark, sf_dir):
    pts = _points(spark, sf_dir)
    ref = F.broadcast(cl.first_centres(pts, 1).select("c"))
    return pts.crossJoin(ref).select(
        F.col("id").alias("vec_id"), _r(sqdist("p", "c")).alias("d2"), _r(euclidean("p", "c")).alias("d")
    )


def _fixed(spark, pts, k=K_FIXED):
    """The k lowest-id points as a model, written once (one top-k pass) so
    that the size check and the broadcast read a k-row table, not the points."""
    return ScratchTables(spark, "fixed").put(cl.first_centres(pts, k).select("cid", "c"), "centres")


def vec_assign(spark, sf_dir):
    pts = _points(spark, sf_dir)
    a = cl.assign_nearest(pts, _fixed(spark, pts))
    return a.select(F.col("id").alias("vec_id"), _long("cid"), _r("d").alias("d"))


def vec_objective(spark, sf_dir):
    pts = _points(spark, sf_dir)
    return cl.objective(pts, _fixed(spark, pts)).select(_r("objective").alias("objective"))


def vec_weights(spark, sf_dir):
    pts = _points(spark, sf_dir)
    return cl.cluster_weights(pts, _fixed(spark, pts)).select(_long("cid"), _long("w"))


def _weighted_points(spark, sf_dir):
    """Points with weight ``1 + label``, read in one projection (no join)."""
    emb = table(spark, sf_dir, "embeddings")
    return points_from_embeddings(emb, keep=((F.col("label") + 1).cast("long").alias("w"),))


def vec_centroid_update(spark, sf_dir):
    pts = _weighted_points(spark, sf_dir)
    c = cl.centroid_update(pts, _fixed(spark, _points(spark, sf_dir)), "w")
    return _explode_centres(c, "cid")


def vec_lloyd(spark, sf_dir):
    pts = _points(spark, sf_dir)
    c = cl.lloyd(pts, _fixed(spark, pts), LLOYD_ROUNDS)
    return _explode_centres(c, "cid")


def vec_seed_first(spark, sf_dir):
    s = cl.seed_centres(_points(spark, sf_dir), 1, SEED)
    return s.select(F.col("id").alias("vec_id"))


def vec_seed(spark, sf_dir):
    s = cl.seed_centres(_points(spark, sf_dir), K, SEED)
    return s.select(F.col("cid").cast("long").alias("ord"), F.col("id").alias("vec_id"))


def vec_seed_bucketed(spark, sf_dir):
    s = cl.seed_centres(_points(spark, sf_dir), K, SEED, n_buckets=BUCKETS)
    return s.select(
        _long("bucket"), F.col("cid").cast("long").alias("ord"), F.col("id").alias("vec_id")
    )


def vec_coreset(spark, sf_dir):
    core = cl.coreset(_points(spark, sf_dir), K, BUCKETS, ITERS, SEED)
    return _explode_centres(core, "bucket", "cid", "w")


def vec_coreset_recluster(spark, sf_dir):
    core = cl.coreset(_points(spark, sf_dir), K, BUCKETS, ITERS, SEED)
    return _explode_centres(cl.recluster(core, K, ITERS, SEED), "cid")


def vec_kmedian(spark, sf_dir):
    """Final centres with the number of points nearest to each (flagship);
    a centre that attracts no point has size 0."""
    pts = _points(spark, sf_dir)
    sized = cl.cluster_sizes(pts, cl.kmedian(pts, K, BUCKETS, ITERS, SEED))
    return _explode_centres(sized, "cid", "w")


def vec_kmedian_objective(spark, sf_dir):
    pts = _points(spark, sf_dir)
    centres = cl.kmedian(pts, K, BUCKETS, ITERS, SEED)
    return cl.objective(pts, centres).select(_r("objective").alias("objective"))


def vec_kmedian_direct(spark, sf_dir):
    c = cl.kmedian_direct(_points(spark, sf_dir), K, ITERS, SEED)
    return _explode_centres(c, "cid")


QUERIES: dict[str, Query] = {
    "num_max_min": num_max_min,
    "num_mean": num_mean,
    "num_count": num_count,
    "num_minmax_scale": num_minmax_scale,
    "num_below_mean": num_below_mean,
    "num_stable_sample": num_stable_sample,
    "num_bernoulli_sample": num_bernoulli_sample,
    "parse_numbers": parse_numbers,
    "parse_vectors": parse_vectors,
    "text_lines": text_lines,
    "text_doc_term_counts": text_doc_term_counts,
    "text_wordcount": text_wordcount,
    "text_wordcount_salted": text_wordcount_salted,
    "text_wordcount_preagg": text_wordcount_preagg,
    "text_distinct_words": text_distinct_words,
    "text_distinct_count": text_distinct_count,
    "text_avg_word_length": text_avg_word_length,
    "vec_distance": vec_distance,
    "vec_assign": vec_assign,
    "vec_objective": vec_objective,
    "vec_weights": vec_weights,
    "vec_centroid_update": vec_centroid_update,
    "vec_lloyd": vec_lloyd,
    "vec_seed_first": vec_seed_first,
    "vec_seed": vec_seed,
    "vec_seed_bucketed": vec_seed_bucketed,
    "vec_coreset": vec_coreset,
    "vec_coreset_recluster": vec_coreset_recluster,
    "vec_kmedian": vec_kmedian,
    "vec_kmedian_objective": vec_kmedian_objective,
    "vec_kmedian_direct": vec_kmedian_direct,
}

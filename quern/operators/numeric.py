"""Statistics of one numeric column: extrema, mean, min-max scaling,
below-mean filter, sampling.

The input column is cleaned once (``numbers``): NULL and NaN rows are left
out (infinities stay), because Spark orders NaN above every number, which would make it the
maximum and make every ``x < NaN`` comparison true.

Scalars reach the row-wise expressions as scalar subqueries
(``DataFrame.scalar()``). Catalyst merges subqueries over the same scan into
one aggregate, so min and max cost one pass, and the filter or projection
that uses them is another, fully code-generated pass. No collect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.random import keyed_uniform


def numbers(df: DataFrame, col: str) -> DataFrame:
    c = F.col(col)
    return df.where(c.isNotNull() & ~F.isnan(c))


def column_stats(df: DataFrame, col: str) -> DataFrame:
    """One row ``n, mx, mn, mean``; on empty input ``n = 0`` and NULLs."""
    x = numbers(df, col)
    c = F.col(col)
    return x.select(
        F.count(F.lit(1)).alias("n"),
        F.max(c).alias("mx"),
        F.min(c).alias("mn"),
        F.avg(c).alias("mean"),
    )


def minmax_scale(df: DataFrame, col: str, out: str = "z") -> DataFrame:
    """Adds ``out = (x - min) / (max - min)``, in [0, 1].

    A constant column has no scale: ``try_divide`` gives NULL (plain ``/``
    raises under ANSI).
    """
    x = numbers(df, col)
    c = F.col(col)
    mx = x.select(F.max(c)).scalar()
    mn = x.select(F.min(c)).scalar()
    return x.withColumn(out, F.try_divide(c - mn, mx - mn))


def below_mean(df: DataFrame, col: str, out: str = "z") -> DataFrame:
    """Scaled rows whose scaled value is strictly below the mean of the scaled
    values (one more pass: in floating point, ``x < mean(x)`` is not the same).

    A constant column scales to NULL and keeps no row. With an infinite value
    the mean is NaN, below which there is nothing; Spark orders NaN last, so
    that case is tested.
    """
    scaled = minmax_scale(df, col, out)
    mean = scaled.select(F.avg(out)).scalar()
    z = F.col(out)
    return scaled.where(z.isNotNull() & ~F.isnan(z) & ~F.isnan(mean) & (z < mean))


def stable_sample(df: DataFrame, id_col: str, fraction: float, seed: int, tag: str = "sample") -> DataFrame:
    """Bernoulli sample keyed by row id: same rows for any file layout or retry."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie in [0, 1]")
    return df.where(keyed_uniform(seed, tag, f"`{id_col}`") < F.lit(float(fraction)))


def bernoulli_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Spark's own sampler: repeatable only for the same partitioning."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie in [0, 1]")
    return df.sample(withReplacement=False, fraction=float(fraction), seed=int(seed))


def sample_facts(df: DataFrame, sample: DataFrame, id_col: str) -> DataFrame:
    """What holds for a sample without replacement under any partitioning, in
    one row: ``n_input`` rows, sampled ids that the input lacks
    (``n_foreign``), and ids sampled more often than they occur
    (``n_surplus``)."""
    ids = df.select(F.col(id_col).alias("id"), F.lit(1).alias("a"), F.lit(0).alias("b"))
    drawn = sample.select(F.col(id_col).alias("id"), F.lit(0).alias("a"), F.lit(1).alias("b"))
    per = ids.unionByName(drawn).groupBy("id").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return per.agg(
        F.coalesce(F.sum("a"), F.lit(0)).alias("n_input"),
        F.count_if((F.col("a") == 0) & (F.col("b") > 0)).alias("n_foreign"),
        F.count_if((F.col("a") > 0) & (F.col("b") > F.col("a"))).alias("n_surplus"),
    )

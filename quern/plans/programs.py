"""The four end-to-end programs, composed from the operators.

Each returns named DataFrames instead of printing; nothing is collected.
Inputs are text files or directories as the programs read them: numbers
separated by whitespace, one document per line, one point per line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quern.operators import clustering as cl
from quern.operators import numeric as num
from quern.operators import text as tx
from quern.sources.numbers import read_numbers
from quern.sources.text import read_lines
from quern.sources.vectors import read_points


def number_statistics(spark: SparkSession, path: str, fraction: float = 0.5, seed: int = 0) -> dict[str, DataFrame]:
    """Extrema and mean, min-max scaled values, the scaled values below their
    mean, and a Bernoulli sample of the scaled values."""
    x = read_numbers(spark, path)
    scaled = num.minmax_scale(x, "x")
    return {
        "stats": num.column_stats(x, "x"),
        "scaled": scaled,
        "below_mean": num.below_mean(x, "x"),
        "sample": num.bernoulli_sample(scaled, fraction, seed),
    }


def word_statistics(spark: SparkSession, path: str, salts: int, seed: int = 0) -> dict[str, DataFrame]:
    """The three word counts (plain, random-key, pre-aggregated), the number
    of distinct words and the average distinct-word length of a text file
    with one document per line."""
    lines = read_lines(spark, path)
    return {
        "wordcount": tx.word_count(lines),
        "wordcount_salted": tx.word_count_salted(lines, salts, seed),
        "wordcount_preagg": tx.word_count_from_term_counts(tx.doc_term_counts(lines)),
        "distinct_words": tx.distinct_word_count(lines),
        "avg_word_length": tx.avg_distinct_word_length(lines),
    }


def kmedian_program(spark: SparkSession, path: str, k: int, n_buckets: int, iters: int, seed: int = 0) -> dict[str, DataFrame]:
    """Three-round k-median of a point file: final centres, their cluster
    sizes and the objective (mean distance to the nearest centre)."""
    pts = read_points(spark, path, partitions=n_buckets)
    centres = cl.kmedian(pts, k, n_buckets, iters, seed)
    return {
        "centres": centres,
        "sizes": cl.cluster_weights(pts, centres),
        "objective": cl.objective(pts, centres),
    }


def kmeans_program(spark: SparkSession, path: str, k: int, iters: int, seed: int = 0) -> dict[str, DataFrame]:
    """k-means++ seeding and Lloyd on all points of a file, and the objective."""
    pts = read_points(spark, path)
    centres = cl.kmedian_direct(pts, k, iters, seed)
    return {"centres": centres, "objective": cl.objective(pts, centres)}


"""Points: ``id BIGINT, p ARRAY<DOUBLE>`` (plus an optional weight ``w``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.text import tokenize
from quern.sources.layout import numbered_lines, spread


def parse_vector(line: Column | str) -> Column:
    """Space-separated doubles to ``ARRAY<DOUBLE>``; a bad token fails the job."""
    s = F.col(line) if isinstance(line, str) else line
    return F.transform(tokenize(s), lambda t: t.cast("double"))


def points_from_text(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), parse_vector(text_col).alias("p"))


def read_points(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """One point per line of a text file or directory; ``id`` is the line's
    number over all files (``layout.numbered_lines``). ``partitions``: see
    ``layout.spread``."""
    df = numbered_lines(spark, path)
    return (spread(df, partitions) if partitions else df).select("id", parse_vector("value").alias("p"))


def points_from_embeddings(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", keep: tuple[Column, ...] = ()
) -> DataFrame:
    """Embedding table to points; FLOAT elements widen exactly to DOUBLE.
    ``keep``: extra columns (e.g. a weight) computed in the same projection."""
    return df.select(
        F.col(id_col).cast("long").alias("id"),
        F.expr(f"transform(`{vec_col}`, _v -> CAST(_v AS DOUBLE))").alias("p"),
        *keep,
    )


def unit_weights(points: DataFrame, out: str = "w") -> DataFrame:
    return points.withColumn(out, F.lit(1).cast("long"))

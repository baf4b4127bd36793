"""Whitespace-delimited numbers (one column of doubles)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.sources.layout import spread

# Fixed value: any run of whitespace separates two numbers, newlines included.
WHITESPACE = r"\s+"


def numbers_from_text(df: DataFrame, text_col: str, keep: tuple[str, ...] = (), out: str = "x") -> DataFrame:
    """Every whitespace-separated token of ``text_col`` as a DOUBLE row.

    Blank pieces vanish; a token that is not a number fails the job (ANSI
    cast), like a parse error would. ``pos`` is the token's index among the
    numbers of its row.
    """
    toks = df.select(*keep, F.split(F.col(text_col), WHITESPACE, -1).alias("_t"))
    toks = toks.select(*keep, F.filter("_t", lambda t: t != "").alias("_t"))
    return toks.select(*keep, F.posexplode("_t").alias("pos", "_v")).select(
        *keep, F.col("pos").cast("long").alias("pos"), F.col("_v").cast("double").alias(out)
    )


def read_numbers(spark: SparkSession, path: str, out: str = "x", partitions: int | None = None) -> DataFrame:
    """A text file (or directory) of numbers, parsed on the executors;
    ``partitions``: see ``layout.spread``."""
    lines = spark.read.text(path).select("value")
    return numbers_from_text(spread(lines, partitions) if partitions else lines, "value", out=out).select(out)

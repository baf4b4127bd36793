"""Line-oriented text: one line is one document of the word statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.text import split_body, strip_final_break
from quern.sources.layout import numbered_lines, spread, spread_few


def read_lines(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """``doc_id, line_no, line`` from text files or directories; one line per row.

    ``doc_id`` is the line's number over all files (``layout.numbered_lines``);
    ``line_no`` is 0, as each file line is its own document. ``partitions``:
    see ``layout.spread``.
    """
    df = numbered_lines(spark, path).select(
        F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("line_no"), F.col("value").alias("line")
    )
    return spread(df, partitions) if partitions else df


def lines_from_table(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None
) -> DataFrame:
    """``doc_id, line_no, line`` from a table whose rows hold whole texts.

    Each text is cut at ``\\r\\n``, ``\\r`` or ``\\n``, like a text file; only
    the two needed columns are read from the scan, and nothing is shuffled,
    unless the caller names ``partitions`` and the table has fewer files
    (``layout.spread_few``).
    """
    if partitions:
        df = spread_few(df.select(id_col, text_col), partitions)
    body = df.select(F.col(id_col).cast("long").alias("doc_id"), strip_final_break(F.col(text_col)).alias("body"))
    return body.select(
        "doc_id",
        F.posexplode(split_body("body")).alias("line_no", "line"),
    ).withColumn("line_no", F.col("line_no").cast("long"))

"""Input layout: an even number of partitions on request, and line numbers
that do not follow the splits of the files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.session import ScratchTables, broadcast_threshold

SPLIT_ROW_BYTES = 512  # bound of a split's row (path, start, offset) in a broadcast


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """``df`` in ``partitions`` partitions: a full shuffle of its rows, for a
    caller who wants it (say, one unsplittable file before heavy work on each
    row). Rows are hash-partitioned on their position in the input, which is
    the same on every task attempt for a file source, so retries agree; unlike
    a round-robin exchange this needs no local sort, and unlike a key-based
    one it stays balanced when one key holds many rows. No job runs here."""
    cols = df.columns
    return df.withColumn("_row", F.monotonically_increasing_id()).repartition(partitions, "_row").select(*cols)


def spread_few(df: DataFrame, partitions: int) -> DataFrame:
    """``spread``, but only for a table of fewer files than ``partitions``: a
    small file is one row group, so one task would do all the work on it. A
    table of many files stays where it is read."""
    return spread(df, partitions) if len(df.inputFiles()) < partitions else df


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``id, value``: the lines of text files or directories, numbered from 0
    in the order of file path and place in the file, however the files are
    split.

    The splits of a text file follow settings that may change between a call
    and an action (split size, cores). So one read decides: each line is
    written once with its split and its place in it to the scratch folder, and
    the count of the lines before its split, taken from that table, gives its
    number. The table of splits is one small row for each and is written too;
    it is broadcast if its rows fit the broadcast threshold. No line is
    shuffled if they do.
    """
    tables = ScratchTables(spark, "lines")
    lines = tables.put(
        spark.read.text(path).select(
            "value",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_m"),
        ),
        "lines",
    )
    counted = lines.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_first"))
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    splits = tables.put(counted.select("_file", "_start", offset.alias("_offset")), "splits")
    fits = splits.count() * SPLIT_ROW_BYTES <= broadcast_threshold(spark)
    return lines.join(F.broadcast(splits) if fits else splits, ["_file", "_start"]).select(
        (F.col("_m") + F.col("_offset")).alias("id"), "value"
    )

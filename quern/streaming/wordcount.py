"""Running word counts over a directory of text files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.text import word_count


def word_counts(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``word, n`` over every line of the text files under ``path``.

    The same plan as the batch ``word_count`` (explode, partial and final
    aggregate); the running counts live in the state store, so write it in
    ``complete`` or ``update`` mode with a checkpoint location.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return word_count(reader.load(path).select(F.col("value").alias("line")))

"""The corpus pipeline: documents pass the quality classifier, line dedup,
near-duplicate removal, benchmark decontamination and BPE encoding.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; ``run`` writes what a
stage returns as Parquet and reads it again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import bpe, decontam, line_dedup, minhash, quality
from quern.llm.catalog import PATTERN, RANKS
from quern.llm.common import table
from quern.session import ScratchTables

#: SQL cannot express the classifier; tests hold the stages against plain versions.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject, unchanged."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).where(F.col("score") >= quality.THRESHOLD).select("row.*")


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many sites share, but for each line's
    earliest occurrence."""
    return line_dedup.clean(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the lowest id."""
    return minhash.dedup(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of the benchmark."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids, n_bytes, decoded_sha256``: the training
    tokens, and length and SHA-256 of the bytes that they decode to. Null and empty
    texts have no ids and no bytes; rows that repeat are encoded each on its own.
    The ids are written before they are decoded: a task that did both would hold two
    Python workers, which executors keep for the tasks after it."""
    done = bpe.encode(docs, RANKS, PATTERN).select("row.doc_id", "row.lang", "row.source", "n_tokens", "ids")
    done = ScratchTables(spark, "encoding").put(done, "tokens")
    back = bpe.decode(done, RANKS, PATTERN)
    return back.select("row.*", F.octet_length("data").cast("long").alias("n_bytes"), F.sha2("data", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_boilerplate),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", cut_benchmark),
    ("encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; only what the last stage reads is kept."""
    tables = ScratchTables(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = tables.put(stage(spark, docs, sf_dir), name)
        tables.keep(docs)
    return STAGES[-1][1](spark, docs, sf_dir)

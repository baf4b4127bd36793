"""The queries of the text operators over the whole driver tables, and the
DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from quern.llm import (
    bpe,
    decontam,
    html_text,
    license_scan,
    line_dedup,
    minhash,
    quality,
    ranked_search,
    repetition,
    substring_dedup,
    token_file,
    wordpiece,
    zone_clusters,
)
from quern.llm.common import table

#: Parameters of the registered queries.
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_byte_bpe(spark, sf_dir):
    got = bpe.encode(table(spark, sf_dir, "documents"), RANKS, PATTERN, digests=True)
    return got.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op2_license_scan(spark, sf_dir):
    return license_scan.digest(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark, sf_dir):
    return substring_dedup.spans(table(spark, sf_dir, "documents"))


def op4_repetition_rules(spark, sf_dir):
    return repetition.rules(table(spark, sf_dir, "documents"))


def op5_html_text(spark, sf_dir):
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op6_decontamination(spark, sf_dir):
    found = decontam.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("spans")


def op7_token_counts(spark, sf_dir):
    return wordpiece.token_counts(table(spark, sf_dir, "documents"), *wordpiece.sentencepiece_vocabulary(PIECES))


def op8_minhash(spark, sf_dir):
    return minhash.classes(table(spark, sf_dir, "documents"))


def op9_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "row.doc_id",
        quality.held_out("row.doc_id").alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op10_line_dedup(spark, sf_dir):
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op11_token_file(spark, sf_dir):
    return token_file.read(spark, token_file.write(table(spark, sf_dir, "documents"), TOKENIZER), digests=True)


def op12_ranked_search(spark, sf_dir):
    return ranked_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_zone_clusters(spark, sf_dir):
    return zone_clusters.clusters(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_byte_bpe,
        op2_license_scan,
        op3_substring_dedup,
        op4_repetition_rules,
        op5_html_text,
        op6_decontamination,
        op7_token_counts,
        op8_minhash,
        op9_quality,
        op10_line_dedup,
        op11_token_file,
        op12_ranked_search,
        op13_zone_clusters,
    )
}

ORACLES = {
    "op2_license_scan": license_scan.ORACLE,
    "op6_decontamination": decontam.ORACLE,
    "op10_line_dedup": line_dedup.ORACLE,
    "op12_ranked_search": ranked_search.ORACLE,
    "op13_zone_clusters": zone_clusters.ORACLE,
}

"""Word statistics of a line collection (``doc_id, line_no, line``).

A line is one document; its words are the tokens of ``functions.tokenize``
(split on single spaces, Java rules). All counts are exact.

Physical shape (``explain``): ``Generate explode`` feeds a partial
``HashAggregate`` in the same code-generated stage, so every task combines
its own words before the shuffle (the per-document and per-partition
pre-aggregation of a hand-written word count), then one ``Exchange`` on the
word and a final ``HashAggregate``. Nothing is grouped into iterables; a hot
word costs one row per task after the partial step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.text import tokenize, utf16_length


def tokens(lines: DataFrame) -> DataFrame:
    """``doc_id, line_no, pos, word``: one row per token occurrence."""
    return lines.select(
        "doc_id",
        "line_no",
        F.posexplode(tokenize(F.col("line"))).alias("pos", "word"),
    ).withColumn("pos", F.col("pos").cast("long"))


def _words(lines: DataFrame) -> DataFrame:
    return lines.select(F.explode(tokenize(F.col("line"))).alias("word"))


def doc_term_counts(lines: DataFrame) -> DataFrame:
    """``doc_id, line_no, word, n``: occurrences of each word in each line.

    A line is one row, so it is counted inside the row (sorted tokens, lengths
    of their runs) and nothing is shuffled.
    """
    toks = lines.select("doc_id", "line_no", F.sort_array(tokenize(F.col("line"))).alias("t"))
    runs = toks.select(
        "doc_id", "line_no", "t",
        F.expr("filter(sequence(0, size(t)), i -> i = size(t) OR i = 0 OR t[i] != t[i - 1])").alias("cut"),
    ).where("size(t) > 0")
    counts = F.expr(
        "transform(slice(cut, 1, size(cut) - 1), "
        "(at, k) -> named_struct('word', t[at], 'n', CAST(cut[k + 1] - at AS BIGINT)))"
    )
    return runs.select("doc_id", "line_no", F.inline(counts))


def word_count(lines: DataFrame) -> DataFrame:
    """``word, n`` over the whole collection (partial + final hash aggregate).

    This one plan covers the combine-then-reduce count and the
    group-then-sum count: Catalyst's partial aggregate combines each task's
    words (so each document's too) before the shuffle. The count built on
    explicit per-document counts is ``word_count_from_term_counts``.
    """
    return _words(lines).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_count_salted(lines: DataFrame, salts: int, seed: int = 0) -> DataFrame:
    """``word, n`` in two rounds: first by ``(word, salt)``, then by word.

    Spreads one hot word over ``salts`` reducers in round one. The salt is a
    hash of the token's own coordinates, so a retried task draws the same
    salts (a random salt would not).
    """
    if salts < 1:
        raise ValueError("salts must be >= 1")
    toks = tokens(lines)
    salt = F.pmod(F.xxhash64(F.lit(int(seed)), "doc_id", "line_no", "pos"), F.lit(int(salts)))
    partial = toks.select("word", salt.alias("salt")).groupBy("word", "salt").agg(
        F.count(F.lit(1)).alias("n")
    )
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def word_count_from_term_counts(term_counts: DataFrame) -> DataFrame:
    """``word, n`` from per-document counts (``doc_term_counts`` rows): the
    pre-aggregated count. The per-document step stays in the row, the partial
    aggregate combines per task, and one exchange on the word follows."""
    return term_counts.groupBy("word").agg(F.sum("n").cast("long").alias("n"))


def distinct_words(lines: DataFrame) -> DataFrame:
    """``word, len``: every distinct word once, with its UTF-16 length."""
    d = _words(lines).distinct()
    return d.select("word", utf16_length(F.col("word")).alias("len"))


def distinct_word_count(lines: DataFrame) -> DataFrame:
    """``n_words``: number of distinct words (the empty word included)."""
    return _words(lines).distinct().agg(F.count(F.lit(1)).alias("n_words"))


def avg_distinct_word_length(lines: DataFrame) -> DataFrame:
    """``avg_len``: mean length over distinct words, each weighing 1."""
    return distinct_words(lines).agg(F.avg("len").alias("avg_len"))

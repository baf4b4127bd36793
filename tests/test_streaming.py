"""The word count runs unchanged on a streaming text source."""

from quern.streaming import word_counts


def test_streaming_word_counts(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("a b a\nb  c \n")
    (src / "b.txt").write_text("\n  \n")
    q = (
        word_counts(spark, str(src), max_files_per_trigger=1)
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName("wc_stream")
        .option("checkpointLocation", str(tmp_path / "ckpt"))
        .start()
    )
    try:
        q.processAllAvailable()
        got = {r.word: r.n for r in spark.sql("SELECT * FROM wc_stream").collect()}
    finally:
        q.stop()
    assert got == {"a": 2, "b": 2, "c": 1, "": 2}

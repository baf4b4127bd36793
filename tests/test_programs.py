"""The four programs end to end on small files, and the command line."""

import pytest

from quern.plans import programs


def test_number_statistics(spark, tmp_path):
    f = tmp_path / "numbers.txt"
    f.write_text("".join(f"{i}.0\n" for i in range(1, 11)) + "\n")
    r = programs.number_statistics(spark, str(f), 0.5, 3)
    st = r["stats"].first()
    assert (st.mx, st.mn, st.mean) == (10.0, 1.0, 5.5)
    assert sorted(x.z for x in r["below_mean"].collect()) == pytest.approx([0, 1 / 9, 2 / 9, 3 / 9, 4 / 9])
    assert 0 <= r["sample"].count() <= 10


def test_word_statistics(spark, tmp_path):
    f = tmp_path / "docs.txt"
    f.write_text("a b a\nb  c \n\n  \n")
    r = programs.word_statistics(spark, str(f), 3)
    want = {"a": 2, "b": 2, "c": 1, "": 2}
    for key in ("wordcount", "wordcount_salted", "wordcount_preagg"):
        assert {x.word: x.n for x in r[key].collect()} == want
    assert r["distinct_words"].first().n_words == 4
    assert r["avg_word_length"].first().avg_len == pytest.approx(0.75)


def test_kmedian_and_kmeans_programs(spark, tmp_path):
    f = tmp_path / "pts.txt"
    f.write_text("".join(f"{x} {y}\n" for x in (0, 1, 10, 11) for y in (0, 1)))
    km = programs.kmedian_program(spark, str(f), 2, 2, 2, seed=1)
    assert km["centres"].count() == 2
    assert sum(x.w for x in km["sizes"].collect()) == 8
    assert km["objective"].first().objective == pytest.approx(0.7071067811865476)
    kk = programs.kmeans_program(spark, str(f), 2, 2, seed=1)
    assert sorted(tuple(x.c) for x in kk["centres"].collect()) == [(0.5, 0.5), (10.5, 0.5)]


def test_command_line_writes_results(spark, tmp_path):
    from quern.__main__ import main

    f = tmp_path / "docs.txt"
    f.write_text("x y x\n")
    out = tmp_path / "out"
    main(["words", "2", str(f), "--out", str(out)])
    got = {r.word: r.n for r in spark.read.parquet(str(out / "wordcount")).collect()}
    assert got == {"x": 2, "y": 1}


def test_command_line_prints_every_row(spark, tmp_path, capsys):
    from quern.__main__ import main

    f = tmp_path / "numbers.txt"
    f.write_text(" ".join(f"{i}.5" for i in range(300)))
    main(["numbers", str(f), "--fraction", "1"])
    out = capsys.readouterr().out
    scaled = out.split("== scaled")[1].split("== ")[0].strip().split("\n")
    assert len(scaled) == 301 and out.split("== sample")[1].strip().count("\n") == 300

"""bench.py prints exactly one JSON line in the driver's format."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_QUERIES="num_count")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True, text=True, timeout=600
    )
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert out.returncode == 0 and len(lines) == 1
    d = json.loads(lines[0])
    assert d["metric"] == "total_query_sec" and d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"num_count"} and d["value"] > 0 and "errors" not in d


@pytest.mark.parametrize("missing", ["quern.llm", "corpus_pipeline", "public_tokenizers"])
def test_queries_without_the_text_operators(missing):
    """A module that is None in ``sys.modules`` cannot be imported."""
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == ["31", "31"], out.stderr

"""Keyed uniforms: repeatable randomness for a distributed job.

``rand()`` and per-task random generators give different draws when a task is
retried or when the input is split differently. A uniform computed from a hash
of ``(seed, tag, id)`` is the same on every attempt and in every engine that has
``md5`` (the DuckDB oracle uses the same formula, see ``keyed_uniform_sql``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 13 hex digits = 52 bits, the mantissa width of a double.
_HEX_DIGITS = 13
_SCALE = 4503599627370496.0  # 2 ** 52


def _key(seed: int, tag: str) -> str:
    return f"{int(seed)}|{tag}|"


def keyed_uniform(seed: int | str, tag: str | int, id_sql: str) -> Column:
    """Uniform in (0, 1) from ``md5('<seed>|<tag>|<id>')``; never 0 or 1.

    ``id_sql`` is a SQL expression (usually a column name). ``seed`` is an
    int, or a SQL expression for one draw per seed row in a single job. Built
    from SQL text: one driver-to-JVM call per use in iterative jobs.
    """
    tag = str(tag).replace("'", "")
    if isinstance(seed, str):
        prefix = f"concat(CAST(CAST({seed} AS BIGINT) AS STRING), '|{tag}|')"
    else:
        prefix = f"'{_key(seed, tag)}'"
    text = f"concat({prefix}, CAST({id_sql} AS STRING))"
    bits = f"CAST(conv(substring(md5({text}), 1, {_HEX_DIGITS}), 16, 10) AS DOUBLE)"
    return F.expr(f"(({bits} + 0.5D) / {_SCALE}D)")


def keyed_uniform_sql(seed: int, tag: str | int, id_sql: str) -> str:
    """The same uniform as a DuckDB expression (for oracle queries)."""
    return (
        f"((('0x' || substr(md5('{_key(seed, str(tag))}' || CAST({id_sql} AS VARCHAR)), 1, {_HEX_DIGITS}))"
        f"::BIGINT::DOUBLE + 0.5) / {_SCALE})"
    )

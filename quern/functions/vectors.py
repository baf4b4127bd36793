"""Vector expressions over ``ARRAY<DOUBLE>`` columns.

The expressions are written as Spark SQL text (``F.expr``): the same
Catalyst expressions as the equivalent ``F.aggregate`` / ``F.zip_with``
builders, but built in one call instead of one driver-to-JVM round trip per
lambda node, which matters in iterative jobs that rebuild them every round.
Arguments are SQL expressions, usually column names.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sqdist_sql(p: str, c: str) -> str:
    """SQL text of the squared distance; fails the task on a dimension
    mismatch (``zip_with`` would silently pad the shorter array with NULL,
    so the lengths are checked in the same expression, no extra pass)."""
    return (
        f"CASE WHEN size({p}) = size({c}) "
        f"THEN aggregate(zip_with({p}, {c}, (_a, _b) -> (_a - _b) * (_a - _b)), 0D, (_s, _t) -> _s + _t) "
        f"ELSE raise_error('vector dimension mismatch') END"
    )


def sqdist(p: str, c: str) -> Column:
    """Squared Euclidean distance between two vector columns."""
    return F.expr(sqdist_sql(p, c))


def euclidean(p: str, c: str) -> Column:
    return F.expr(f"sqrt({sqdist_sql(p, c)})")


def nearest_centre(p: str, centres: str) -> Column:
    """Nearest entry of an ``ARRAY<STRUCT<cid INT, c ARRAY<DOUBLE>>>`` column.

    Returns ``STRUCT<d2 DOUBLE, cid INT>``: the smallest squared distance and
    its centre id; on equal distances the lowest ``cid`` wins (struct order).
    NULL when the array is empty. A narrow projection: no shuffle and no
    k-fold row blow-up.
    """
    return F.expr(
        f"array_min(transform({centres}, _e -> named_struct('d2', {sqdist_sql(p, '_e.c')}, 'cid', _e.cid)))"
    )

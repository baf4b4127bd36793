"""Column-level building blocks (no DataFrame in, Column out)."""

from quern.functions.random import keyed_uniform, keyed_uniform_sql
from quern.functions.text import split_body, split_lines, strip_final_break, tokenize, utf16_length
from quern.functions.vectors import euclidean, nearest_centre, sqdist, sqdist_sql

__all__ = [
    "keyed_uniform",
    "keyed_uniform_sql",
    "split_lines",
    "strip_final_break",
    "split_body",
    "tokenize",
    "utf16_length",
    "sqdist",
    "euclidean",
    "nearest_centre",
    "sqdist_sql",
]

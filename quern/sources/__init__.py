"""Readers: whitespace number files, line-oriented text, vector files, and
the matching adapters for tables that already hold the values."""

from quern.sources.numbers import numbers_from_text, read_numbers
from quern.sources.text import lines_from_table, read_lines
from quern.sources.vectors import (
    parse_vector,
    points_from_embeddings,
    points_from_text,
    read_points,
    unit_weights,
)

__all__ = [
    "read_numbers",
    "numbers_from_text",
    "read_lines",
    "lines_from_table",
    "parse_vector",
    "read_points",
    "points_from_text",
    "points_from_embeddings",
    "unit_weights",
]

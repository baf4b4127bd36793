"""Streaming use of the text operators.

The reference has no streaming job; this package only shows that the word
statistics are plain DataFrame operators and therefore run unchanged on a
Structured Streaming source (see ``word_counts``).
"""

from quern.streaming.wordcount import word_counts

__all__ = ["word_counts"]

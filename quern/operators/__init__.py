"""DataFrame operators: numeric column statistics, word statistics, and
coreset k-median clustering."""

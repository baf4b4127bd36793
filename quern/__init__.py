"""quern: DataFrame operators for numeric column statistics, word statistics
of text collections, and coreset-based k-median clustering of vectors.

Every operator is a plain function ``DataFrame -> DataFrame`` built from Spark
SQL expressions, so Catalyst plans (and prunes, pushes down, codegens) the
whole chain. Randomness is keyed by ``(seed, tag, id)`` hashes, never by
``rand()``, so recomputed tasks and different partitionings agree.
"""

__version__ = "0.1.0"

"""Bindings of the operators: the query catalogue over the driver's tables
(``catalog``), its DuckDB oracle SQL (``oracle``) and the four end-to-end
programs (``programs``)."""

"""hearth: housing-market signals as Spark DataFrame operators.

Layers
------
functions/  Column -> Column helpers (tolerant casts, keys, payload access)
operators/  DataFrame -> DataFrame building blocks (envelope, joins, windows,
            aggregates, merges, data-quality checks)
sources/    file scans and sinks (CSV, JSON, JSONL, partitioned tables, extracts)
streaming/  incremental file pickup and streaming de-duplication
plans/      the models composed from the operators, the bindings to the
            driver's test tables, and the matching DuckDB oracle SQL
"""

__version__ = "0.1.0"

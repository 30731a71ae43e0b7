"""hearth: housing-market periodic-data analytics on Spark.

Layers:
  functions/  Column -> Column expressions (derived metrics, hygiene, rounding, text, dates)
  operators/  DataFrame -> DataFrame operators (reshape, fill-down, filters, joins, aggregates)
  sources/    readers for landed files (delimited, preamble TSV, wide series, JSON, SQL views)
  sinks/      period-partitioned writes, freshness gate, deletes, snapshots, exports
  quality/    audit rows, conformance reports, quarantine
  plans/      declarative specs per source family and their compositions
  streaming/  file-stream front end for incremental loads
  bindings/   the operators bound to the benchmark tables (queries + oracle SQL)
"""

__version__ = "0.1.0"

"""registrar: Spark-native migration and reconciliation of administrative records.

Sub-packages:
  sources    record-file and delimited ingest, table specs, exclusion lists
  functions  column-expression helpers (value parsing, codes, dates, documents)
  operators  DataFrame operators (interval algebra, lookups, aggregates, quality, identity)
  sinks      publishing (append, insert-ignore, upsert, update-from, delete-by-key)
  plans      reconciliation jobs over staged tables and the star-schema query set
  streaming  incremental ingest with Structured Streaming
"""

__version__ = "0.1.0"

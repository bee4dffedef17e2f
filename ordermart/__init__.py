"""ordermart: order-to-delivery ETL and analytics on Spark.

Layers:
  sources/    OLTP/warehouse schemas, test-data binding, extracts, control log, sinks
  functions/  column expressions for calendar parts and partition keys
  operators/  dimension/fact transforms, dense surrogate keys, dedupe, quality checks
  plans/      star-schema build, analytics questions, end-to-end batch, DuckDB oracle SQL
  streaming/  micro-batch driver for the incremental batch
"""

__version__ = "0.1.0"

"""quarry: incremental web-document archive ingestion and analytics on Spark.

Layout:
  functions/  column expressions (text cleanup, dates, response parsing)
  sources/    readers and writers (CSV archive, silver Parquet, landing tables)
  operators/  table operators (filters, reports, crawl window, extraction,
              annotation, topic catalogue, size-checked joins)
  plans/      composed jobs (ingest, backfill, report) and the query catalog
  streaming/  Structured Streaming forms (incremental ingest, daily counts)
"""

__version__ = "0.1.0"

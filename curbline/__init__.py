"""Trip analytics on Spark: ingest, refine and aggregate trip records."""

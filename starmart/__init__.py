"""Star-schema analytics on Spark: ingest, staging, dimensions, facts, checks and questions."""

"""Head-to-head results on Spark: ingest, quality checks, standings, recent form."""

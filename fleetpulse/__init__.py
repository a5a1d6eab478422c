"""Fleet sensor telemetry on Spark: typed ingest, quality rules, marts, ledgers and labels."""

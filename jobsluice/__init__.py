"""Job-posting pipeline on Spark: page extraction, tagging, deduplication, snapshots and feeds."""

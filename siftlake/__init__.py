"""Event ingestion, vetting and layering as ordinary Spark DataFrame jobs."""

"""Document analytics on Spark: corpus building, extraction, search and sync plans."""

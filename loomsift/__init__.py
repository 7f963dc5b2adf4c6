"""Document-curation analytics expressed as PySpark DataFrame jobs."""

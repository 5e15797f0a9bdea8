"""Bibliographic dump ingestion and catalog building as Spark DataFrame transforms."""

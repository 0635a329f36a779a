"""Structured Streaming entry points: file-stream bronze ingestion and the
foreachBatch medallion refresh."""

"""Whole plans: schemas, ingestion of a checkpoint, generations of tables, and the query catalogue."""

"""Continuous ingestion: the watch over new archives, and the streaming form of the same."""

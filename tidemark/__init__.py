"""Versioned-state analytics on Spark: decode ledger checkpoints, keep current state, derive serving tables."""

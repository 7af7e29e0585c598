"""Relational operators over DataFrames: versions, balances, token info, tombstones, metadata, routing, serving."""

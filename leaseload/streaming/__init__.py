"""Incremental runs of plans that only append."""

"""Batch operators: cleaning (C), upsert (C8/M7), data quality (Q), governance (G)."""

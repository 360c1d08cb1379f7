"""Streaming medallion path (L1-L6) on Structured Streaming file sources."""

"""Sources and sinks: zone lake (B1, B5, B6), messy reads (B2), incremental file ingest (B3, B4)."""

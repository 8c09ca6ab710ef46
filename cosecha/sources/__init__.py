"""Scans and sinks: Parquet stores, CSV, SAS XPORT (Python data source),
zip archives, the replace sink, store copy and the ingest report."""

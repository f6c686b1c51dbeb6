"""Scans and sinks: raw text files in, Parquet tables and graph exports out."""

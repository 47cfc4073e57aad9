"""Readers: SQL dumps, triples, link tables, traffic files, map-feature TSV, label caches, Parquet footers."""

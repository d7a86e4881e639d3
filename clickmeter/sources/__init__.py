"""Readers and writers: click stream, raw archive, ads catalog, aggregate table."""

"""Readers and writers: record streams, files, tables."""

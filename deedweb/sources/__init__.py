"""Readers, writers, dataset catalog and schema contracts."""

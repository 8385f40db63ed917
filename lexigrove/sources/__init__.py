"""Readers and writers of tables and document bundles."""

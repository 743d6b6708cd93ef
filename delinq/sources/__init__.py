"""Readers, writers, catalog tables and views over the supplied test tables."""

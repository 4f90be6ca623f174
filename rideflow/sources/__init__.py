"""Readers, writers, lake layout and the mapping from the test tables."""

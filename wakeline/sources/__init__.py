"""Readers, writers, routing, registered layer tables and file compaction."""

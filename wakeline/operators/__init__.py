"""Reusable relational operators: ordered neighbours, de-duplication, checked joins, merges."""

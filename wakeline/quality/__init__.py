"""Expectations on tables and the suites of the gold and silver tables."""

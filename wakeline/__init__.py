"""Ship-position analytics on Apache Spark: every stage takes and returns a DataFrame."""

__version__ = "0.1.0"

"""Change-log to star-schema analytics as PySpark DataFrame jobs."""

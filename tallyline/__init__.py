"""Contest analytics as Spark DataFrame jobs."""

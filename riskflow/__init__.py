"""Transaction-risk analytics as PySpark DataFrame jobs."""

"""Subject-level event streams to numbered, encoded samples, as Spark DataFrame jobs."""

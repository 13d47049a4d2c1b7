"""Social-text sentiment analytics as Spark jobs."""

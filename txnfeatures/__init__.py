"""Transaction features and fraud scoring as Spark jobs."""

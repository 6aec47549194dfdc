"""Customer-retention analytics as Spark DataFrame operations."""

"""Full-text search and search analytics as plain Spark DataFrame jobs."""

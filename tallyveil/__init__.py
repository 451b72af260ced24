"""Private statistics and tabulation as plain Spark DataFrame operations."""

"""Column functions; each takes and returns Spark Columns."""

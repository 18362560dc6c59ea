"""Media-catalog and transcript analytics as Spark DataFrame operations."""

"""Change-event analytics expressed as Spark DataFrame operations."""

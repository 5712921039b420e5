"""Point-in-time panel analytics expressed as Spark DataFrame operations."""

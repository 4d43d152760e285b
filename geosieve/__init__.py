"""Site screening and corpus preparation as Spark DataFrame operations."""

"""Payment-risk analytics on Spark tables and streams."""

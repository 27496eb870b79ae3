"""Payment-fraud medallion analytics as plain PySpark DataFrame and Structured Streaming jobs."""

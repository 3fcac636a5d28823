"""Document ingestion and collection analytics as Spark DataFrames."""

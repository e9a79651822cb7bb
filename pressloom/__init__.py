"""News ingestion, merge and media-analytics operators for Spark DataFrames."""

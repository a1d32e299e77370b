"""Message-stream ingestion, tables and analytics as PySpark jobs."""

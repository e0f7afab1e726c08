"""A PySpark medallion engine: sources, expressions, transforms, sinks, queue ingestion, control and quality."""

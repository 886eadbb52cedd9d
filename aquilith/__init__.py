"""A lakehouse engine for meter telemetry on PySpark."""

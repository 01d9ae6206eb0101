"""Production-line telemetry analytics on Spark DataFrames and streams."""

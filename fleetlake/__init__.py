"""A Spark-native lake for vehicle telemetry: ingest, daily summaries and views."""

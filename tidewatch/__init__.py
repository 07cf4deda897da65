"""Edit-stream analytics on Spark: ingest, features, windows, anomalies, dashboard queries."""

"""Incremental vehicle-telemetry batches as Spark jobs."""

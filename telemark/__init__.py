"""A Spark engine for daily device telemetry: ingest, contract checks, snapshot tables, reliability marts."""

"""Stream steps: ingest columns, table sinks and event-time windows."""

"""Sources and sinks: topics (Kafka or files), tables, and driver-table adapters."""

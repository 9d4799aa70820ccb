"""Acting layer: sinks, table maintenance, jobs, and the query catalogue."""

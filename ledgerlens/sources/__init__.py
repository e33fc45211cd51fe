"""Table registry, typed readers and sinks."""

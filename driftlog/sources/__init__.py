"""Sources and sinks: raw lines and batch files, the bus, the hot table, the cold archive."""

"""Sources and sinks: raw log readers, the keyword dictionary, test-data adapters."""

"""Sources and sinks: tables, text lines / topics, JSON, dimensions."""

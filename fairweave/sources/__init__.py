"""Sources and sinks of listings."""

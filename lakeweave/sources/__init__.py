"""Sources and sinks: versioned tables, the Bronze fixture, path helpers."""

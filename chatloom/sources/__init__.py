"""Sources (file scanners, table readers) and sinks."""

"""Table schemas, readers and the wave-versioned table store."""

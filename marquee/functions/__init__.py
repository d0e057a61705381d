"""Column-to-column functions; native expressions only."""

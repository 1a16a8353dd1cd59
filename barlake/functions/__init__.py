"""Column-level building blocks (no action, no I/O)."""

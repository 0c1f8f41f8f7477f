"""Column expressions, all built in; no Python function runs per row."""

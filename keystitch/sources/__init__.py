"""Table descriptors, readers and writers."""

"""Whole jobs. A job stages what it uses more than once, and returns the new table with its report."""

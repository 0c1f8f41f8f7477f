"""Keep tables in step, link records by codes in text, and check the result, on Spark."""

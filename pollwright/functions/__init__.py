"""Column functions: pure expressions, no jobs and no Python UDFs."""

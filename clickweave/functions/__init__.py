"""Column expressions and named SQL functions."""

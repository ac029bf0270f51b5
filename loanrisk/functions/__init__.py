"""Column expressions. Each takes columns (or column names) and returns one `Column`."""

"""Reading and writing: raw schema, CSV files and stored tables."""

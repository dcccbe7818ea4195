"""Independent SQL for DuckDB that gives the result each query is checked against."""

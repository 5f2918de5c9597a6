"""The same queries as SQL for DuckDB, to check results against."""

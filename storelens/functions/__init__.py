"""Column functions. All are built-in expressions; there is no Python UDF."""

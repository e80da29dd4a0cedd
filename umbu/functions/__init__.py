"""Column functions; all of them are built-in expressions, none a Python UDF."""

"""Column expressions; nothing in here is a Python UDF."""

"""Column expressions. Each takes and returns ``Column``; none uses a Python UDF."""

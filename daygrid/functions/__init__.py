"""Column expressions. Everything here is built from Spark's own functions."""

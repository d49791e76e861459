"""Analytics over sparse entity-by-day panels, written as plain Spark jobs."""

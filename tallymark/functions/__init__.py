"""Column expressions: money arithmetic, values, names, times."""

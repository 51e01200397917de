"""Column expressions and ordered building blocks."""

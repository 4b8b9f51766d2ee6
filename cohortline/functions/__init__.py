"""Column expressions and fixed value tables."""

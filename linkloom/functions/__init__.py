"""Column expressions; none of them moves data."""

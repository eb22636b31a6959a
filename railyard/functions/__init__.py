"""Column expressions and bulk look-ups."""

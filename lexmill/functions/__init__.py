"""Column expressions and Arrow functions on text."""

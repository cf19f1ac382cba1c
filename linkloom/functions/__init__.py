"""Column expressions: text, categories, products."""

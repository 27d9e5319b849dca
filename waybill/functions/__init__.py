"""Column expressions: text, fuzzy similarity, addresses."""

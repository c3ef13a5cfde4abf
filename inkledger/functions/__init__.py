"""Column expressions: parsing of texts, keys, and display forms."""

"""Column expressions: text, type names, delimited lines, key ranges."""

"""Column expressions: text, code, arrays and vectors."""

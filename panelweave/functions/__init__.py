"""Column expressions: missing codes, recodes, names."""

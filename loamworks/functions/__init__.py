"""Column expressions: scores, rules and indices."""

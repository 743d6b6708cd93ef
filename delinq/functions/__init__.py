"""Column expressions: every function takes and returns ``Column`` objects."""

"""Column expressions: calendar, categories, measures, keys, cleaning."""

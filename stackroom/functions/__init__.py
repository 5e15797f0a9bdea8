"""Column expressions: text, JSON, TSV, dates and record fields."""

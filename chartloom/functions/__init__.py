"""Column expressions: keys and display text, dates, coded lists, variant values, JSON."""

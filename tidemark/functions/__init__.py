"""Column expressions: text, numbers, dates, units and depositary shares."""

"""Column expressions: measures, labels and row rules."""

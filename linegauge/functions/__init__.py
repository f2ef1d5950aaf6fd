"""Column expressions: normal curve, rounding, segment rules, labels, JSON text."""

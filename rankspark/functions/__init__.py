"""Column expressions: text analysis, scoring formulas, test distributions."""

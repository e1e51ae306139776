"""Column functions: text cleaning, number parsing, guarded ratios."""

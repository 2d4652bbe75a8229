"""Column expressions and small statistic tables."""

"""Column expressions, scalar helpers and the feature calculators."""

"""Column expressions: guarded ratios, missing values, tiers, measures."""

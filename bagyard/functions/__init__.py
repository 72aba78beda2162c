"""Column expressions (scalar functions F01-F17 and path/rights helpers)."""

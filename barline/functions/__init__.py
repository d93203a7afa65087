"""Column functions: null-safe scalars and trading-row windows."""

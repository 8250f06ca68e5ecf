"""Column expressions and aggregates the operators share."""

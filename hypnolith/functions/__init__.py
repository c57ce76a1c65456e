"""Column expressions and key helpers shared by the operators."""

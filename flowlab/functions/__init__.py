"""Column expressions: no plan, no action, no state."""

"""Column-in, Column-out expressions."""

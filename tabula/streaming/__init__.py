"""Incremental forms of two batch operators, for inputs that arrive daily."""

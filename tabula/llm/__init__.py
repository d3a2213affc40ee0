"""Operators for training-data preparation: one module per operator, their queries in ``queries``."""

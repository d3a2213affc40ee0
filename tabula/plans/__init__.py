"""Composed jobs: table cleaning, reports, chart tables, lap features, model tasks."""

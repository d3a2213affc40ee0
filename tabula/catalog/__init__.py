"""Registered queries with their independent SQL, by name."""

from __future__ import annotations

from tabula.catalog import (charts, cleaning, evaluation, features, ingest, modelling, reports, summaries)
from tabula.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
_ = (charts, cleaning, evaluation, features, ingest, modelling, reports, summaries)

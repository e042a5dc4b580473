"""Queries over the given tables, one or more per operator."""

from __future__ import annotations

import importlib

MODULES = ("ingest", "columns", "relational", "analytic", "streams", "checks", "tables", "dimensions",
           "layers", "files", "security", "reports")


def load() -> None:
    for name in MODULES:
        importlib.import_module(f"lakeloom.cases.{name}")

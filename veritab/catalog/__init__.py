"""Registered queries over the given tables, one per operator."""

from __future__ import annotations

import importlib

from veritab.catalog.registry import ORACLES, QUERIES

MODULES = (
    "scans", "projections", "joins", "comparisons", "aggregations", "windows", "scalars", "stages", "assessment", "scripts", "runs",
)


def load():
    for name in MODULES:
        importlib.import_module(f"veritab.catalog.{name}")
    return dict(QUERIES), dict(ORACLES)

"""Registered queries, one module per operator family."""

from __future__ import annotations

import importlib

MODULES = ("windows", "joins", "aggregates", "sources", "projections", "quality", "lake", "streams")

for _name in MODULES:
    importlib.import_module(f"ticklake.plans.{_name}")

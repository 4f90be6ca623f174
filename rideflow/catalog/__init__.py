"""Named queries over the given tables, each with the SQL it must agree with where SQL can say it."""

from __future__ import annotations

import importlib

from rideflow.catalog import registry

MODULES = ("business", "relational", "scalar", "quality", "lake", "streams")


def load():
    """Import every catalog module and return the registry."""
    for name in MODULES:
        importlib.import_module(f"rideflow.catalog.{name}")
    return registry

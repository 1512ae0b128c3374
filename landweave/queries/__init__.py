"""All registered queries of the land-change operators, with the SQL that gives the same rows."""

from __future__ import annotations

import importlib
import pkgutil

from landweave.queries.base import ORACLES, QUERIES

for _module in pkgutil.iter_modules(__path__):
    importlib.import_module(f"{__name__}.{_module.name}")

__all__ = ["ORACLES", "QUERIES"]

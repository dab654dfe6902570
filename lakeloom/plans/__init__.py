"""Registered queries over the driver's tables, with their oracle SQL.

Each module of this package has QUERIES (name -> f(spark, sf_dir)) and ORACLES
(name -> DuckDB SQL).
"""

from __future__ import annotations

import importlib

_NAMES = ("pricing", "projection", "scalars", "joining", "aggregation", "functions", "learning", "networks")


def modules() -> list:
    """The modules that register queries."""
    return [importlib.import_module(f"{__name__}.{n}") for n in _NAMES]

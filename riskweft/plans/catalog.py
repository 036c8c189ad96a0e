"""All registered queries, gathered from the modules of this package."""

from __future__ import annotations

import importlib

from riskweft.plans.registry import ORACLES, QUERIES, Query

MODULES = [
    "sources",
    "validation",
    "features",
    "profile",
    "splits",
    "stats",
    "metrics",
    "preprocess",
    "models",
    "streaming",
]


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"riskweft.plans.queries_{name}")


def queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)

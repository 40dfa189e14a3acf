"""Named queries over the given tables, each with its SQL check where one exists."""

from __future__ import annotations

import importlib

from tabulon.plans import registry

GROUPS = (
    "sources", "logs", "club", "aggregates", "series", "forecast",
    "features", "evaluation", "models", "clustering", "anomaly",
)


def load() -> None:
    for group in GROUPS:
        importlib.import_module(f"tabulon.plans.{group}")


def queries():
    load()
    return dict(registry.QUERIES)


def oracle_sql():
    load()
    return dict(registry.ORACLES)

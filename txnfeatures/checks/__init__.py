"""Named queries over the given tables, each with a SQL twin where SQL can say it."""

from __future__ import annotations

from importlib import import_module

MODULES = ["features", "scalars", "cleaning", "statistics", "quality", "evaluation", "storage", "learning"]


def _merged(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        for key, value in getattr(import_module(f"txnfeatures.checks.{name}"), attribute).items():
            if key in out:
                raise ValueError(f"query {key} is registered twice")
            out[key] = value
    return out


def all_queries() -> dict:
    return _merged("QUERIES")


def all_oracles() -> dict:
    return _merged("ORACLES")

"""All bound queries and their SQL twins."""

from __future__ import annotations

from importlib import import_module

from sitegrade.bindings.common import Query

MODULES = ("scoring", "inventory", "contacts", "evidence", "runs", "links", "tables", "cells")


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for name in MODULES:
        part = getattr(import_module(f"sitegrade.bindings.{name}"), attribute)
        repeated = merged.keys() & part.keys()
        if repeated:
            raise ValueError(f"query registered twice: {sorted(repeated)}")
        merged.update(part)
    return merged


def queries() -> dict[str, Query]:
    return _merged("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _merged("ORACLES")

"""All registered queries. Importing a module of this package registers its queries."""

from __future__ import annotations

import importlib

GROUPS = ["medallion", "risk", "governance", "ingest"]


def _load():
    for group in GROUPS:
        importlib.import_module(f"tidemark.plans.catalogue.{group}")
    from tidemark.plans.catalogue import common
    return common


def queries() -> dict:
    return dict(_load().QUERIES)


def oracles() -> dict:
    return dict(_load().ORACLES)

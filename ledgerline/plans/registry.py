"""All registered queries, gathered from the catalogue modules."""

from __future__ import annotations

import importlib

MODULES = ["ledgerline.plans.catalog", "ledgerline.plans.catalog_quality",
           "ledgerline.plans.catalog_jobs"]


def all_queries():
    out = {}
    for m in MODULES:
        out.update(importlib.import_module(m).REGISTRY)
    return out

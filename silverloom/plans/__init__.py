"""Named queries, grouped by what they do. Importing a module registers its queries."""

from __future__ import annotations

import importlib

MODULES = ("rows", "relations", "rollups", "reports", "catalogue", "rules")


def load_all() -> None:
    for name in MODULES:
        importlib.import_module(f"{__name__}.{name}")

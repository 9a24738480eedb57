"""Queries: operators bound to the standard tables, each with the SQL that checks it."""

from __future__ import annotations

import importlib
import pkgutil


def load() -> None:
    """Import every module here; importing registers its queries."""
    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")

"""All queries of the engine and their SQL."""

from __future__ import annotations

from . import registry
from .plans import load


def queries() -> dict[str, registry.Query]:
    load()
    return dict(registry.QUERIES)


def oracles() -> dict[str, str]:
    load()
    return dict(registry.ORACLES)

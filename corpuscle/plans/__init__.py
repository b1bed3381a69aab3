"""Named queries: importing this package registers all of them."""

from __future__ import annotations

from importlib import import_module
from pkgutil import iter_modules

from corpuscle.plans.registry import REGISTRY, Query


def all_queries() -> dict[str, Query]:
    for module in iter_modules(__path__):
        import_module(f"{__name__}.{module.name}")
    return dict(REGISTRY)

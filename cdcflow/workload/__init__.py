"""Test workload: inputs derived from the given tables, and the registered queries."""

import importlib
import pkgutil
from types import ModuleType


def load() -> ModuleType:
    """Import every ``queries_*`` module and return the registry."""
    for info in sorted(pkgutil.iter_modules(__path__), key=lambda i: i.name):
        if info.name.startswith("queries_"):
            importlib.import_module(f"{__name__}.{info.name}")
    return importlib.import_module(f"{__name__}.registry")

"""Queries over the supplied tables, each with the SQL that must give the same rows."""

from importlib import import_module
from pkgutil import iter_modules


def load_all() -> None:
    """Import every module of this package, which registers its queries."""
    for module in iter_modules(__path__):
        import_module(f"{__name__}.{module.name}")

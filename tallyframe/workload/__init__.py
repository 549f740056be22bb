"""The operators run over the given tables, each with the SQL that must agree with it."""

from importlib import import_module

from .registry import REGISTRY, Query

MODULES = ["scans", "rows", "joins", "totals", "windows", "values", "reports", "finals", "contracts", "atsize"]


def all_queries() -> dict[str, Query]:
    for name in MODULES:
        import_module(f"{__name__}.{name}")
    return REGISTRY

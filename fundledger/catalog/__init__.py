"""The registered queries: each a Spark function with the SQL it is checked against."""

from __future__ import annotations

from importlib import import_module

from fundledger.catalog import registry

SECTIONS = ("holdings", "funds", "securities", "filings", "storage", "streams", "rollups", "bucketed")


def _load() -> None:
    for section in SECTIONS:
        import_module(f"fundledger.catalog.{section}")


def all_queries() -> dict[str, registry.Query]:
    _load()
    return dict(registry.QUERIES)


def all_checks() -> dict[str, str]:
    _load()
    return dict(registry.CHECKS)

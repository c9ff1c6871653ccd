"""Registered queries over the given tables."""

from __future__ import annotations

from importlib import import_module

from tellurion.plans import registry

GROUPS = ("ingest", "state", "media", "health", "evidence", "streams")


def _load() -> None:
    for group in GROUPS:
        import_module(f"tellurion.plans.{group}")


def all_queries() -> dict[str, registry.Query]:
    _load()
    return dict(registry.QUERIES)


def all_checks() -> dict[str, str]:
    _load()
    return dict(registry.CHECKS)

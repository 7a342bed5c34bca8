"""All queries of the core, by name."""

from __future__ import annotations

from importlib import import_module

MODULES = ("problems", "catalog", "temporal", "sequences", "pixels", "streams", "kernels", "jobs", "products", "archives", "imaging")


def _all(what: str) -> dict:
    out: dict = {}
    for m in MODULES:
        part = getattr(import_module(f"obsforge.plans.{m}"), what)
        if twice := out.keys() & part.keys():
            raise ValueError(f"queries named twice: {sorted(twice)}")
        out |= part
    return out


def queries() -> dict:
    return _all("QUERIES")


def oracle_sql() -> dict:
    return _all("ORACLE")

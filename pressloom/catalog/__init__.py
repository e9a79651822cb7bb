"""Registered queries: each pairs a Spark build with the SQL it must equal."""

from importlib import import_module

MODULES = ["intake", "merging", "analysis", "streams"]


def load_all() -> None:
    for name in MODULES:
        import_module(f"pressloom.catalog.{name}")

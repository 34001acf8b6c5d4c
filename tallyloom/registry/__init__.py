"""The checked queries, grouped as the library is."""

from importlib import import_module

SECTIONS = ("retail", "marketplace", "metrics", "sources", "keyed", "streams")


def load():
    for section in SECTIONS:
        import_module(f"tallyloom.registry.{section}")
    return import_module("tallyloom.registry.base")

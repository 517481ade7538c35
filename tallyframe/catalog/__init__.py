"""Registered queries with the equivalent SQL."""

from importlib import import_module

MODULES = ["wrangling", "scalars", "describe", "models", "engineering", "evaluation", "charts"]


def load():
    for name in MODULES:
        import_module(f"tallyframe.catalog.{name}")
    return import_module("tallyframe.catalog.registry")

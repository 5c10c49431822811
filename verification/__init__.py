"""Registered queries with the SQL they are compared against."""

from importlib import import_module

MODULES = ("tables", "quality", "states", "assistant", "streams", "models", "primitives")


def registries():
    return [import_module(f"verification.{m}").R for m in MODULES]

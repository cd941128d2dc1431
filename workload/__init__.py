"""Registered queries over the given tables, each with its oracle SQL."""

import importlib

MODULES = ("cleanup", "policy", "planning", "archive", "purge", "schema", "reports", "streams")


def load():
    """Import every query module; returns the registry."""
    registry = importlib.import_module("workload.registry")
    for name in MODULES:
        importlib.import_module(f"workload.{name}")
    return registry

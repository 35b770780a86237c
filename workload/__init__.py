"""Queries over the test tables that exercise every operator."""

import importlib

MODULES = ("filters", "points", "merges", "hierarchies", "records", "graphs", "jobs", "streams", "matching")


def load_all() -> None:
    for name in MODULES:
        importlib.import_module(f"workload.{name}")

"""Map and array rules shared by merges and change detection."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def merge_map(old: Column, new: Column) -> Column:
    """Keys of ``new`` added to or overwriting those of ``old``."""
    kept = F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(new), k))
    return (
        F.when(old.isNull(), new)
        .when(new.isNull(), old)
        .otherwise(F.map_concat(kept, new))
    )


def add_items(old: Column, new: Column) -> Column:
    """Items of ``new`` added to ``old``, each once."""
    return F.when(old.isNull(), new).when(new.isNull(), old).otherwise(F.array_union(old, new))


def sorted_entries(column: Column) -> Column:
    """A comparable form of a map; absent and empty maps compare equal."""
    return F.coalesce(F.array_sort(F.map_entries(column)), F.array())


def same_map(a: Column, b: Column) -> Column:
    return sorted_entries(a).eqNullSafe(sorted_entries(b))


def same_list(a: Column, b: Column) -> Column:
    """Element-wise, order matters; absent and empty lists compare equal."""
    return F.coalesce(a, F.array()).eqNullSafe(F.coalesce(b, F.array()))

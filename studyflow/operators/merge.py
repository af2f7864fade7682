"""Difference, merge and upsert of keyed row sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def diff(old: DataFrame, new: DataFrame, keys: list[str], values: list[str], flag: str = "flag") -> DataFrame:
    """Full-outer comparison on unique keys: ``new`` / ``changed`` / ``deleted`` / ``identical``.

    The value columns hold the new side, or the old side of deleted rows.
    """
    left = old.select(*keys, F.struct(*values).alias("__old"))
    right = new.select(*keys, F.struct(*values).alias("__new"))
    both = left.join(right, keys, "full")
    same = reduce(lambda a, b: a & b, [F.col(f"__old.{v}").eqNullSafe(F.col(f"__new.{v}")) for v in values])
    state = (
        F.when(F.col("__old").isNull(), "new")
        .when(F.col("__new").isNull(), "deleted")
        .when(same, "identical")
        .otherwise("changed")
    )
    kept = F.coalesce("__new", "__old")
    return both.select(*keys, *[kept[v].alias(v) for v in values], state.alias(flag))


def apply(difference: DataFrame, delete: bool = True, flag: str = "flag") -> DataFrame:
    """The table after the flagged changes."""
    rows = difference.where(F.col(flag) != "deleted") if delete else difference
    return rows.drop(flag)


def upsert(
    old: DataFrame, new: DataFrame, keys: list[str], values: list[str], keep_old_when_null: list[str] | None = None
) -> DataFrame:
    """Insert-or-update by key; listed columns keep the old value where the new one is null."""
    keep = set(keep_old_when_null or [])
    left = old.select(*keys, F.struct(*values).alias("__old"))
    right = new.select(*keys, F.struct(*values).alias("__new"))
    both = left.join(right, keys, "full")

    def pick(v: str):
        if v in keep:
            return F.coalesce(F.col(f"__new.{v}"), F.col(f"__old.{v}"))
        return F.when(F.col("__new").isNotNull(), F.col(f"__new.{v}")).otherwise(F.col(f"__old.{v}"))

    return both.select(*keys, *[pick(v).alias(v) for v in values])


def insert_missing(existing: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key is not there yet."""
    return rows.join(existing.select(*keys).distinct(), keys, "left_anti")


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.subtract(right)


def replace_where(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Delete the groups present in the new rows, then add the new rows."""
    return old.join(new.select(key).distinct(), key, "left_anti").select(*old.columns).unionByName(new)


def cascade(tables: dict[str, tuple[DataFrame, str]], doomed: DataFrame, key: str) -> dict[str, DataFrame]:
    """Remove a key set from every table that refers to it."""
    out = {}
    for name, (table, column) in tables.items():
        out[name] = table.join(doomed.select(F.col(key).alias(column)).distinct(), column, "left_anti").select(*table.columns)
    return out

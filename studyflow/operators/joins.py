"""Join helpers.

The kind of a join is left to run-time statistics: a side that turns out
small is broadcast, a skewed key is split. Nothing runs while a plan is built.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi join in which null keys match each other; the left keys are kept once."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    joined = left.join(renamed, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__r_{k}" for k in keys])


def no_case(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner") -> DataFrame:
    """Join on trimmed upper-case keys."""
    keyed_left = left.withColumn("__k", F.upper(F.trim(F.col(left_key))))
    keyed_right = right.withColumn("__k", F.upper(F.trim(F.col(right_key))))
    return keyed_left.join(keyed_right, "__k", how).drop("__k")


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in the given order (map-side combined, no window)."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return picked.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*df.columns)


def lookup(
    df: DataFrame, table: DataFrame, keys: dict[str, str], values: dict[str, object], order: list[str] | None = None
) -> DataFrame:
    """Keyed lookup with a default per value; the first match wins where ``order`` is given.

    ``keys`` maps stream columns to table columns, ``values`` table columns to defaults.
    """
    side = table.select(*[F.col(t).alias(f"__k_{s}") for s, t in keys.items()], *values)
    if order:
        side = first_by(
            table.select(*dict.fromkeys([*keys.values(), *values, *order])), list(keys.values()), order
        ).select(*[F.col(t).alias(f"__k_{s}") for s, t in keys.items()], *values)
    on = reduce(lambda a, b: a & b, [F.col(s) == F.col(f"__k_{s}") for s in keys])
    out = df.join(side, on, "left").drop(*[f"__k_{s}" for s in keys])
    defaults = {v: F.coalesce(F.col(v), F.lit(d)) for v, d in values.items() if d is not None}
    return out.withColumns(defaults) if defaults else out


def template_key(template: Column, cut: Column, token: str, value: Column) -> Column:
    """A join key that is active only where the cut template names the token."""
    return F.when(F.locate(token, F.substring(template, F.lit(1), cut)) > 1, F.coalesce(value, F.lit(""))).otherwise("")


def with_constants(df: DataFrame, constants: DataFrame, columns: list[str]) -> DataFrame:
    """Attach the columns of a one-row frame as scalar subqueries (fails on more than one row)."""
    return df.withColumns({c: constants.select(c).scalar() for c in columns})

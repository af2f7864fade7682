"""Row-level projection, routing and validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studyflow.functions.text import is_numeric, strip, to_number


def retype(df: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Select, rename, cast and reorder: ``{source: (target, type)}``."""
    return df.select(*[F.col(s).cast(t).alias(n) for s, (n, t) in columns.items()])


def split(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that meet the condition and all others (an unknown condition is false)."""
    known = F.coalesce(condition, F.lit(False))
    return df.where(known), df.where(~known)


def switch(df: DataFrame, column: str, cases: dict[str, str], default: str | None = None, out: str = "route") -> DataFrame:
    """Name the branch of every row."""
    branch = reduce(lambda acc, kv: acc.when(F.col(column) == kv[0], kv[1]), cases.items(), F)
    return df.withColumn(out, branch.otherwise(F.lit(default)))


def set_constants(df: DataFrame, constants: dict[str, object], copies: dict[str, str] | None = None) -> DataFrame:
    return df.withColumns({
        **{k: F.lit(v) for k, v in constants.items()}, **{k: F.col(v) for k, v in (copies or {}).items()}
    })


def default_nulls(df: DataFrame, defaults: dict[str, object], null_out: dict[str, object] | None = None) -> DataFrame:
    """Replace nulls by defaults, and the listed values by null."""
    out = df.withColumns({k: F.nullif(F.col(k), F.lit(v)) for k, v in (null_out or {}).items()}) if null_out else df
    return out.fillna(defaults)


def map_values(df: DataFrame, column: str, pairs: dict[str, str], default: str | None = None, out: str | None = None) -> DataFrame:
    """Code -> text for a short literal dictionary."""
    chain = reduce(lambda acc, kv: acc.when(F.col(column) == kv[0], kv[1]), pairs.items(), F)
    return df.withColumn(out or column, chain.otherwise(F.lit(default) if default is not None else F.col(column)))


def check_required(df: DataFrame, required: list[str], out: str = "missing_fields") -> DataFrame:
    """Name the required fields that are null or blank; '' marks a valid row."""
    tests = [F.when(F.coalesce(strip(F.col(c).cast("string")), F.lit("")) == "", c) for c in required]
    return df.withColumn(out, F.concat_ws(",", *tests))


def numeric_or_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Numbers, with anything unparsable set to null."""
    return df.withColumns({c: to_number(c) for c in columns})


def numeric_only(df: DataFrame, column: str) -> DataFrame:
    """Drop the rows whose value is no number."""
    return df.where(is_numeric(column)).withColumn(column, to_number(column))


def strip_and_map_samples(
    df: DataFrame, sample: str, suffix_pattern: str, mapping: DataFrame, key: str, value: str, out: str = "sample_cd"
) -> DataFrame:
    """Strip a suffix, then rename mapped samples; unmapped ones pass through."""
    bare = df.withColumn("__s", F.regexp_replace(F.col(sample), suffix_pattern, ""))
    side = mapping.select(F.col(key).alias("__s"), F.col(value).alias("__v"))
    return bare.join(side, "__s", "left").withColumn(out, F.coalesce("__v", "__s")).drop("__s", "__v")


def exclude_records(values: DataFrame, listed: DataFrame, record: str, on: list[str]) -> DataFrame:
    """Drop every record that holds a listed (column, value) pair."""
    bad = values.join(listed.select(*on).distinct(), on, "left_semi").select(record).distinct()
    return values.join(bad, record, "left_anti")

"""Statistical column expressions (JVM side, no Python UDF)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Coefficients of the published rational error-function
# approximation (constant term first), and the significance constants.
ERF_COEFFICIENTS = [
    -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
    0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277,
]
NPV_FLOOR = 1e-5
Z_CLAMP = 2.5
# end of fixed values


def erf_magnitude(x: Column, t: Column) -> Column:
    """Size of the error function at ``x`` for ``t = erf_step(x)``."""
    series = reduce(lambda acc, k: F.lit(k) + t * acc, reversed(ERF_COEFFICIENTS[:-1]), F.lit(ERF_COEFFICIENTS[-1]))
    return F.lit(1.0) - t * F.exp(series - x * x)


def erf_step(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.abs(x) * 0.5)


def sign_of(x: Column) -> Column:
    """The value at 0 takes the negative branch."""
    return F.when(x > 0, 1.0).otherwise(-1.0)


def erf(x: Column) -> Column:
    return sign_of(x) * erf_magnitude(x, erf_step(x))


def standard_score(x: Column, mu: Column, sigma: Column) -> Column:
    """``(x - mu) / (sigma * sqrt 2)``; null where sigma is 0 or null."""
    return F.try_divide(x - mu, sigma) / F.sqrt(F.lit(2.0))


def norm_cdf(x: Column, mu: Column, sigma: Column) -> Column:
    return (F.lit(1.0) + erf(standard_score(x, mu, sigma))) * 0.5


def at_least(p: Column, floor: float = NPV_FLOOR) -> Column:
    return F.when(p < floor, F.lit(floor)).otherwise(p)


def tea_npv(fold_change: Column, mu: Column, sigma: Column, floor: float = NPV_FLOOR) -> Column:
    """Upper-tail p-value of the absolute fold change, never below ``floor``."""
    return at_least(F.lit(1.0) - norm_cdf(F.abs(fold_change), mu, sigma), floor)


def with_npv(df: DataFrame, fold_change: Column, mu: Column, sigma: Column, out: str = "npv", floor: float = NPV_FLOOR) -> DataFrame:
    """``tea_npv`` as a column, built in steps so that each shared term is computed once per row."""
    x, step = F.col("__x"), F.col("__t")
    scored = df.withColumn("__x", standard_score(F.abs(fold_change), mu, sigma)).withColumn("__t", erf_step(x))
    upper = scored.withColumn("__p", F.lit(0.5) - sign_of(x) * erf_magnitude(x, step) * 0.5)
    return upper.withColumn(out, at_least(F.col("__p"), floor)).drop("__x", "__t", "__p")


def clamp(x: Column, limit: float = Z_CLAMP) -> Column:
    return F.when(x > limit, F.lit(limit)).when(x < -limit, F.lit(-limit)).otherwise(x)


def zscore(x: Column, median: Column, sd: Column, limit: float = Z_CLAMP) -> Column:
    """Median-centred score; 0 where the spread is 0, null where it is unknown."""
    return F.when(sd == 0, F.lit(0.0)).otherwise(clamp(F.try_divide(x - median, sd), limit))


def log_base(x: Column, base: float) -> Column:
    return F.log(float(base), x)

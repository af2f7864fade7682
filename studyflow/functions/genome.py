"""Column expressions for variant, genotype and chromosome encodings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from studyflow.functions.paths import split_list
from studyflow.functions.text import strip

# Numeric codes of the non-autosomal chromosomes.
CHROMOSOME_CODES = {"X": "23", "Y": "24", "XY": "25", "MT": "26"}
# end of fixed values


def lookup(c: Column, pairs: dict[str, str]) -> Column:
    """Code -> text from a literal dictionary, null when absent."""
    return F.create_map(*[F.lit(v) for pair in pairs.items() for v in pair])[c]


def chromosome_code(c: Column, pairs: dict[str, str] | None = None) -> Column:
    return F.coalesce(lookup(c, pairs or CHROMOSOME_CODES), c)


def info_attribute(info: Column, name: str) -> Column:
    """Value of ``name=`` in a ``k=v;k=v`` list, '' when absent."""
    found = F.filter(split_list(info, ";"), lambda kv: F.startswith(kv, F.lit(name + "=")))
    return F.coalesce(strip(F.substring(F.try_element_at(found, F.lit(-1)), len(name) + 2, 1 << 30)), F.lit(""))


def genotype(call: Column, calls: dict[str, str]) -> Column:
    """Two-allele text of a call code; the no-call pair becomes 00."""
    return F.replace(lookup(call, calls), F.lit("NN"), F.lit("00"))


def alleles(pair: Column) -> Column:
    """`` A B`` from ``AB``."""
    return F.concat(F.lit(" "), F.substring(pair, 1, 1), F.lit(" "), F.substring(pair, 2, 1 << 30))

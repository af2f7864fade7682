"""Wide / long / list reshaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studyflow.functions.paths import split_list
from studyflow.functions.text import strip


def unpivot_matrix(
    df: DataFrame, ids: list[str], columns: list[str] | None = None, name: str = "sample", value: str = "intensity",
    drop_empty: bool = True,
) -> DataFrame:
    """Matrix of one column per sample to long rows, without empty cells."""
    columns = columns or [c for c in df.columns if c not in ids]
    # names may hold dots, as sample file names do
    cells = [F.struct(F.lit(c).alias(name), F.col(f"`{c}`").cast("string").alias(value)) for c in columns]
    long = df.select(*ids, F.inline(F.array(*cells)))
    return long.where(strip(F.col(value)) != "") if drop_empty else long


def unpivot_lines(lines: DataFrame, header: list[str], n_ids: int, line: str = "line", sep: str = "\t") -> DataFrame:
    """Unpivot delimited matrix lines of any width without declaring a column per sample.

    ``header`` is the split header line (its width is one file line). Lines with
    more cells than that are in ``uneven_lines``.
    """
    cells = split_list(line, sep)
    samples = F.array(*[F.lit(h) for h in header[n_ids:]])
    zipped = F.arrays_zip(samples.alias("sample"), F.slice(cells, n_ids + 1, max(len(header) - n_ids, 1)).alias("intensity"))
    ids = [F.get(cells, F.lit(i)).alias(h) for i, h in enumerate(header[:n_ids])]
    exploded = lines.select(*ids, F.explode(zipped).alias("__c"))
    out = exploded.select(*header[:n_ids], F.col("__c").getField("sample").alias("sample"), strip(F.col("__c").getField("intensity")).alias("intensity"))
    return out.where(F.col("intensity") != "")


def uneven_lines(lines: DataFrame, header: list[str], line: str = "line", sep: str = "\t") -> DataFrame:
    """Lines whose cells the header does not name, or that end before it: rejects of ``unpivot_lines``."""
    n = F.size(split_list(line, sep))
    return lines.withColumn("n_cells", n).where(F.col("n_cells") != len(header))


def split_rows(df: DataFrame, column: str, sep: str, out: str | None = None, position: str | None = None) -> DataFrame:
    """One row per non-blank item of a delimited list."""
    out = out or column
    items = split_list(column, sep)
    if position:
        rows = df.select("*", F.posexplode(items).alias("__p", "__item")).withColumn(position, F.col("__p") + 1)
    else:
        rows = df.select("*", F.explode(items).alias("__item"))
    rows = rows.withColumn(out, strip("__item")).drop("__item", "__p")
    return rows.where(F.col(out) != "")


def rows_to_columns(
    df: DataFrame, ids: list[str], key: str, value: str, names: list[str]
) -> DataFrame:
    """Key/value rows to the declared columns (one conditional aggregate, no pivot pass)."""
    return df.groupBy(*ids).agg(*[F.max(F.when(F.col(key) == n, F.col(value))).alias(n) for n in names])


def zip_lists(
    df: DataFrame, lists: dict[str, str], sep: str, control: Column
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Zip parallel lists position by position: (result, reject, discard).

    Rows under ``control`` are discarded; rows whose lists differ in length are
    rejected. ``lists`` maps list columns to item names.
    """
    control = F.coalesce(control, F.lit(False))
    sizes = [F.size(split_list(c, sep)) for c in lists]
    uneven = F.greatest(*sizes) != F.least(*sizes)
    good = df.where(~control & ~uneven)
    zipped = F.arrays_zip(*[split_list(c, sep).alias(n) for c, n in lists.items()])
    rest = [c for c in df.columns if c not in lists]
    result = good.select(*rest, F.explode(zipped).alias("__z")).select(
        *rest, *[strip(F.col("__z").getField(n)).alias(n) for n in lists.values()]
    )
    return result, df.where(~control & uneven), df.where(control)

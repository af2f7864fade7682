"""Mapping-driven standardisation of wide clinical tables.

A *raw* frame has one row per record (``rec_num`` plus the file's columns).
A *mapping* frame has one row per mapped column: ``category_cd``,
``column_number`` (1-based), ``data_label``, ``label_source``. It is read from
a curated mapping file; a column may be mapped more than once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studyflow.functions import text as T
from studyflow.operators.grouping import record_concat

# Reserved labels that give a value of the whole record.
RECORD_LABELS = {"SITE_ID": "site_id", "SUBJ_ID": "subject_id", "VISIT_NAME": "visit_name", "VISIT_NAME_2": "visit_name_2", "VISIT_DATE": "visit_date", "SAMPLE_CD": "sample_cd"}
LABEL_SOURCE = r"^([0-9]+)([AB]?)$"


def to_cells(raw: DataFrame, record: str, columns: list[str]) -> DataFrame:
    """One row per (record, column number)."""
    cells = F.array(*[
        F.struct(F.lit(i + 1).alias("column_number"), F.col(c).cast("string").alias("value")) for i, c in enumerate(columns)
    ])
    return raw.select(F.col(record), F.explode(cells).alias("__c")).select(record, "__c.column_number", "__c.value")


def header_labels(columns: list[str], spark) -> DataFrame:
    """Column number -> header text, for labels taken from the header row."""
    return spark.createDataFrame([(i + 1, c) for i, c in enumerate(columns)], "column_number int, header string")


def record_columns(cells: DataFrame, mapping: DataFrame, record: str, names: dict[str, str]) -> DataFrame:
    """Flatten the reserved columns (subject, site, visit …) to one row per record.

    The mapping has a row per column of a file, so it is broadcast: shuffled by their
    few column numbers, the cells of a column would be one task's work.
    """
    held = mapping.where(F.col("data_label").isin(list(names))).select("column_number", "data_label")
    reserved = cells.join(F.broadcast(held), "column_number")
    return reserved.groupBy(record).agg(
        *[F.max(F.when(F.col("data_label") == k, T.clean_column("value"))).alias(v) for k, v in names.items()]
    )


def word_map(cells: DataFrame, words: DataFrame) -> DataFrame:
    """Replace listed values per column; unlisted ones pass through."""
    side = words.select("column_number", F.col("from_value").alias("value"), F.col("to_value").alias("__to"))
    return cells.join(side, ["column_number", "value"], "left").select(
        *[c for c in cells.columns if c != "value"], F.coalesce("__to", "value").alias("value")
    ).select(*cells.columns)


def drop_missing(cells: DataFrame, value: str = "value", preserve_nulls: bool = False) -> DataFrame:
    """Drop null, blank and ``.`` values."""
    return cells if preserve_nulls else cells.where(~F.coalesce(T.strip(F.col(value)), F.lit("")).isin("", "."))


def merge_visits(first: Column, second: Column) -> Column:
    """``v1\\v2``, or the one that is present."""
    return F.nullif(F.concat_ws("\\", T.blank_to_null(first), T.blank_to_null(second)), F.lit(""))


def append_unit(value: Column, unit: Column) -> Column:
    return F.concat_ws(" ", value, T.blank_to_null(unit))


def mask_sequence(number: Column, width: int = 3, missing: int = -1) -> Column:
    """Sequence text padded to at least ``width`` digits; ``-1`` where there is none."""
    text = number.cast("string")
    return F.when(number.isNull(), F.lit(str(missing))).when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def reformat(c: Column, source_mask: str, target_mask: str) -> Column:
    """Move characters from a source mask to a target mask (letters name positions)."""
    pieces = []
    for ch in target_mask:
        at = source_mask.find(ch)
        pieces.append(F.substring(c, at + 1, 1) if at >= 0 else F.lit(ch))
    return F.concat(*pieces)


def mapping_rules(mapping: DataFrame, n_columns: int) -> DataFrame:
    """The mapping rows with their numbers parsed and the reason to reject a row, null for a good one.

    A row needs a category (unless its label is reserved) and a column of the
    file; a label taken from another column needs a readable source column.
    """
    rules = mapping.select(
        "category_cd", F.col("column_number").try_cast("int").alias("column_number"), "data_label",
        F.nullif(F.regexp_extract("label_source", LABEL_SOURCE, 1), F.lit("")).try_cast("int").alias("source"),
        F.coalesce(F.nullif(F.regexp_extract("label_source", LABEL_SOURCE, 2), F.lit("")), F.lit("A")).alias("side"),
    )
    reserved = F.coalesce(F.col("data_label").isin([*T.RESERVED_LABELS, *RECORD_LABELS]), F.lit(False))
    in_file = lambda c: F.coalesce(F.col(c).between(1, n_columns), F.lit(False))
    reason = (
        F.when(~in_file("column_number"), "COLUMN").when(T.blank_to_null("data_label").isNull(), "LABEL")
        .when(~reserved & T.blank_to_null("category_cd").isNull(), "CATEGORY")
        .when((F.col("data_label") == "\\") & ~in_file("source"), "LABEL_SOURCE")
    )
    return rules.withColumns({"reserved": reserved, "reason": reason})


def mapping_rejects(mapping: DataFrame, n_columns: int) -> DataFrame:
    """Mapping rows that ``by_mapping`` cannot use, with the reason."""
    return mapping_rules(mapping, n_columns).where("reason is not null").select("category_cd", "column_number", "data_label", "reason")


def without_listed(raw: DataFrame, record: str, columns: list[str], listed: DataFrame) -> DataFrame:
    """Drop every record that holds a listed (column number, value) pair; pairs of columns that the file has not match nothing."""
    pairs = listed.select(F.col("column_number").try_cast("int").alias("column_number"), "value").distinct()
    bad = to_cells(raw, record, columns).join(pairs, ["column_number", "value"], "left_semi").select(record).distinct()
    return raw.join(bad, record, "left_anti")


def by_mapping(
    raw: DataFrame, mapping: DataFrame, record: str, columns: list[str], words: DataFrame | None = None,
    exclusions: DataFrame | None = None, preserve_nulls: bool = False, details: bool = False,
) -> DataFrame:
    """Wide file to (record, site, subject, visit, label, value, category) rows.

    A record is one array of its values, the mapping one array of its rules; the
    plan does not grow with the mapped columns, and nothing is joined. Handles reserved
    labels, labels taken from another column of the record (``\\`` with source
    ``nA`` / ``nB``), word mapping and record exclusion. Rows of the mapping
    that cannot be used are in ``mapping_rejects``; a label column without a
    value gives no row. A mapping without a subject column, and a record
    without a subject, fail the load. With ``details`` the visit date, the sample code and whether
    the visit is named before the subject (``visit_first``) follow.
    """
    rows = raw if exclusions is None else without_listed(raw, record, columns, exclusions)
    rules = mapping_rules(mapping, len(columns)).where("reason is null")
    values = F.array(*[F.col(c).cast("string") for c in columns])
    held = rules.where("reserved")
    # One row of places: the columns of the reserved labels, read as scalars.
    places = held.agg(*[F.min(F.when(F.col("data_label") == k, F.col("column_number"))).alias(v) for k, v in RECORD_LABELS.items()])
    at = {v: places.select(v).scalar() for v in RECORD_LABELS.values()}
    subject_at = places.select(F.coalesce("subject_id", F.raise_error(F.lit("the mapping names no subject column")).cast("int")).alias("n")).scalar()

    def special(name: str) -> Column:
        return T.clean_column(F.get("__values", (subject_at if name == "subject_id" else at[name]) - 1))

    subject = T.blank_to_null(special("subject_id"))
    known = F.coalesce(subject, F.raise_error(F.concat(F.lit("record without subject: "), F.col(record).cast("string"))).cast("string"))
    visit = merge_visits(special("visit_name"), special("visit_name_2"))
    whole = rows.select(record, values.alias("__values")).select(
        record, "__values", F.nullif(special("site_id"), F.lit("")).alias("site_id"), known.alias("subject_id"), visit.alias("visit_name"),
        T.blank_to_null(special("visit_date")).alias("visit_date"), T.blank_to_null(special("sample_cd")).alias("sample_cd"),
        F.coalesce(at["visit_name"] < at["subject_id"], F.lit(False)).alias("visit_first"),
    )
    applied = rules.where("not reserved").agg(F.collect_list(F.struct("column_number", "category_cd", "data_label", "source", "side"))).scalar()

    def cell(rule: Column) -> Column:
        from_column = rule["data_label"] == "\\"
        label = F.when(from_column, T.blank_to_null(F.get("__values", rule["source"] - 1))).otherwise(rule["data_label"])
        return F.struct(
            rule["column_number"].alias("column_number"), F.get("__values", rule["column_number"] - 1).alias("value"), label.alias("data_label"),
            rule["category_cd"].alias("category_cd"), F.when(from_column, rule["side"]).alias("__side"),
        )

    # The cells are picked inside the record, so none of them carries the record on.
    picked = whole.withColumn("__rules", applied).withColumn("__cells", F.transform("__rules", cell)).drop("__values", "__rules")
    mapped = picked.select(*[c for c in picked.columns if c != "__cells"], F.inline("__cells"))
    category = F.when(F.col("__side").isNotNull(), T.insert_label_token(F.col("category_cd"), F.col("__side"))).otherwise(F.col("category_cd"))
    long = mapped.withColumns({"data_label": T.clean_column("data_label"), "category_cd": T.clean_column(category)}).where("data_label is not null").drop("__side")
    if words is not None:
        long = word_map(long, words)
    kept = drop_missing(long, preserve_nulls=preserve_nulls)
    more = ["visit_date", "sample_cd", "visit_first"] if details else []
    return kept.select(
        record, "column_number", "site_id", "subject_id", "visit_name", "data_label", T.clean_column("value").alias("data_value"), "category_cd", *more
    )


def joined_parts(cells: DataFrame, sources: DataFrame, record: str, sep: str = " ", out: str = "label") -> DataFrame:
    """Labels or values made of several columns of a record, in the mapped order (the mapping is broadcast, see ``record_columns``)."""
    picked = cells.join(F.broadcast(sources.select("column_number", "target", "seq")), "column_number")
    return record_concat(picked, [record, "target"], F.col("value"), F.col("seq"), sep, out)


def unmapped_columns(headers: DataFrame, mapping: DataFrame) -> DataFrame:
    """File columns the mapping says nothing about."""
    return headers.join(mapping.select(F.col("column_number").try_cast("int")), "column_number", "left_anti")


def unresolved_labels(mapping: DataFrame, headers: DataFrame) -> DataFrame:
    """Mapped columns whose label column is not in the file."""
    source = mapping.where(F.col("data_label") == "\\").withColumn(
        "source_column", F.nullif(F.regexp_extract("label_source", LABEL_SOURCE, 1), F.lit("")).try_cast("int")
    )
    known = headers.select(F.col("column_number").alias("source_column"))
    return source.join(known, "source_column", "left_anti").select("column_number", "label_source")


def parse_dates(df: DataFrame, date: str, formats: list[str], time: str | None = None, out: str = "visit_date") -> DataFrame:
    """Parse a date with the first format that fits; take a time column only if the date has none.

    ``<out>_status``: OK, MISSING, BAD_DATE or TIME_WITHOUT_DATE.
    """
    raw = T.blank_to_null(date)
    has_time = F.contains(raw, F.lit(":"))
    full = raw
    if time:
        full = F.when(~has_time & T.blank_to_null(time).isNotNull(), F.concat_ws(" ", raw, T.blank_to_null(time))).otherwise(raw)
    parsed = F.coalesce(*[F.try_to_timestamp(full, F.lit(f)) for f in formats])
    alone = T.blank_to_null(time).isNotNull() if time else F.lit(False)
    status = (
        F.when(raw.isNull() & alone, "TIME_WITHOUT_DATE").when(raw.isNull(), "MISSING")
        .when(parsed.isNull(), "BAD_DATE").otherwise("OK")
    )
    return df.withColumns({out: parsed, f"{out}_status": status})


def dates_by_mapping(raw: DataFrame, mapping: DataFrame, record: str, subject: str, columns: list[str], time_format: str = "HH:mm") -> DataFrame:
    """record, subject, data_label, column_number, the parsed date and its status for every cell whose mapping row has a ``date_format``.

    The format is the mapping row's own; a column mapped twice is parsed twice. Where the text has no time, that of the row's ``time_column``
    is added. Status: OK, MISSING, BAD_DATE or TIME_WITHOUT_DATE.
    """
    number = lambda c: F.col(c).try_cast("int").alias(c)
    rules = mapping.where(T.blank_to_null("date_format").isNotNull()).select(number("column_number"), "data_label", T.strip("date_format").alias("date_format"), number("time_column"))
    applied = rules.agg(F.collect_list(F.struct(*rules.columns))).scalar()
    values = F.array(*[F.col(c).cast("string") for c in columns])
    value = lambda n: T.blank_to_null(F.get("__values", n - 1))
    cells = F.transform("__rules", lambda r: F.struct(r["data_label"].alias("data_label"), r["column_number"].alias("column_number"), r["date_format"].alias("__format"), value(r["column_number"]).alias("__date"), value(r["time_column"]).alias("__time")))
    rows = raw.select(record, F.col(subject).alias("subject_id"), values.alias("__values"), applied.alias("__rules")).select(record, "subject_id", F.inline(cells))
    timed = T.has("__date", ":")
    text = F.when(~timed & F.col("__time").isNotNull(), F.concat_ws(" ", "__date", "__time")).otherwise(F.col("__date"))
    layout = F.when(timed | F.col("__time").isNotNull(), F.concat_ws(" ", "__format", F.lit(time_format))).otherwise(F.col("__format"))
    parsed = rows.withColumn("date", F.try_to_timestamp(text, layout))
    status = (
        F.when(F.col("__date").isNull() & F.col("__time").isNotNull(), "TIME_WITHOUT_DATE").when(F.col("__date").isNull(), "MISSING")
        .when(F.col("date").isNull(), "BAD_DATE").otherwise("OK")
    )
    return parsed.select(record, "subject_id", "data_label", "column_number", F.when(F.col("__date").isNotNull(), F.col("date")).alias("date"), status.alias("status"))


def enrol_dates(dated: DataFrame, label: str = "ENROLL_DATE") -> DataFrame:
    """The enrol-date table: each subject's earliest date, with the number of different ones and of cells without a readable date."""
    return dated.where(F.col("data_label") == label).groupBy("subject_id").agg(
        F.min("date").alias("enrol_date"), F.count_distinct("date").alias("n_dates"), F.count_if(F.col("status") != "OK").alias("n_unreadable")
    )


def label_files_report(rows: DataFrame, label: str, file: str, subject: str) -> DataFrame:
    """A special label may come from one file only; counts files and subjects per label."""
    return rows.groupBy(label).agg(
        F.count_distinct(file).alias("n_files"), F.count_distinct(subject).alias("n_subjects")
    ).withColumn("valid", F.col("n_files") <= 1)


def display_mapping(rows: DataFrame, display: DataFrame, category: str = "category_cd") -> DataFrame:
    """Attach display value, label and unit to the categories that have one."""
    side = display.select(category, "display_value", "display_label", "display_unit")
    return rows.join(side, category, "left")

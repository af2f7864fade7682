"""Clinical working rows to nodes, patients and facts.

Working rows carry ``study_id, site_id, subject_id, visit_name, data_label,
data_value, category_cd``; the steps below run in the listed order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studyflow.functions import paths as P
from studyflow.functions import text as T
from studyflow.operators.joins import null_safe
from studyflow.operators.merge import upsert
from studyflow.operators.numbering import surrogate_ids
from studyflow.session import staged

TYPE_KEYS = ["category_cd", "data_label", "visit_name"]


def add_keys(rows: DataFrame, study: str = "study_id") -> DataFrame:
    """Category path and subject key; rows without a value are dropped."""
    return rows.where(F.col("data_value").isNotNull()).withColumns({
        "category_path": T.category_path("category_cd"),
        "usubjid": T.subject_key(F.col(study), "site_id", "subject_id"),
    })


def clean_marks(rows: DataFrame) -> DataFrame:
    """Pipes and parentheses in values, pipes in labels (as separate projections: each reads the last one's result)."""
    piped = rows.withColumns({"data_value": T.clean_pipes("data_value"), "data_label": T.clean_label_pipes("data_label")})
    opened = piped.withColumn("data_value", T.drop_broken("data_value", "(", ")"))
    return opened.withColumn("data_value", T.drop_broken("data_value", ")", "("))


def single_visits(rows: DataFrame) -> DataFrame:
    """Categories with exactly one visit (case-insensitive); counted, as the least and the greatest text would sort all rows."""
    return rows.groupBy("category_cd").agg(F.count_distinct(F.upper("visit_name")).alias("__n")).where("__n = 1").select("category_cd")


def drop_single_visits(rows: DataFrame) -> DataFrame:
    """Null the visit where its category knows exactly one (case-insensitive).

    The rows are written once for the count and the join. The counted side is
    written too: its size is known when the join is planned, so a small one is
    broadcast and the rows are not shuffled by their few categories.
    """
    rows = staged(rows, "keyed-rows")
    single = staged(single_visits(rows).withColumn("__single", F.lit(True)), "single-visits")
    joined = rows.join(single, "category_cd", "left")
    return joined.withColumn("visit_name", F.when(F.col("__single").isNull(), F.col("visit_name"))).select(*rows.columns)


def trim_repeated_label(rows: DataFrame) -> DataFrame:
    """Drop the last path part where it repeats the label (case-insensitive)."""
    repeats = F.coalesce(
        F.upper(F.try_element_at(P.split_list("category_path", "\\"), F.lit(-1))) == F.upper("data_label"), F.lit(False)
    )

    def without_last(c: str, sep: str) -> Column:
        pieces = P.split_list(c, sep)
        return F.array_join(F.slice(pieces, F.lit(1), F.size(pieces) - 1), sep)

    return rows.withColumns({
        "category_path": F.when(repeats, without_last("category_path", "\\")).otherwise(F.col("category_path")),
        "category_cd": F.when(repeats, without_last("category_cd", "+")).otherwise(F.col("category_cd")),
    })


def drop_repeated_visits(rows: DataFrame) -> DataFrame:
    """Null the visit where it repeats the label or the value, or the template only asks for a label."""
    visit = F.col("visit_name")
    label_only = T.has("category_cd", T.DATALABEL) & ~T.has("category_cd", T.VISITNAME)
    repeated = (visit == F.col("data_label")) | (visit == F.col("data_value")) | label_only
    return rows.withColumn("visit_name", F.when(~F.coalesce(repeated, label_only), visit))


def spell_symbols(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "data_label": T.words_for_symbols("data_label", plus=True, underscore=True),
        "data_value": T.words_for_symbols("data_value", plus=True),
        "category_cd": T.words_for_symbols("category_cd"),
        "category_path": T.words_for_symbols("category_path"),
    })


def tidy(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: T.tidy_spaces(c) for c in ("data_label", "data_value", "visit_name")})


def standardise(rows: DataFrame) -> DataFrame:
    """All cleaning steps in order."""
    out = rows
    for step in (
        add_keys, clean_marks, drop_single_visits, trim_repeated_label, drop_repeated_visits, spell_symbols, tidy,
    ):
        out = step(out)
    return out


def numeric_variables(rows: DataFrame) -> DataFrame:
    """Variables all of whose values are numbers (nulls do not count)."""
    checked = rows.groupBy(*TYPE_KEYS).agg(
        F.bool_and(T.is_numeric("data_value")).alias("__all")
    )
    return checked.where("__all").select(*TYPE_KEYS)


def infer_types(rows: DataFrame) -> DataFrame:
    """``data_type`` N where the whole variable is numeric, else T.

    The rows are written once; the numeric variables are written too, as a
    side of known size (see ``drop_single_visits``).
    """
    rows = staged(rows, "clean-rows")
    numeric = staged(numeric_variables(rows), "numeric-variables").withColumn("__n", F.lit("N"))
    return null_safe(rows, numeric, TYPE_KEYS, "left").withColumn("data_type", F.coalesce("__n", F.lit("T"))).drop("__n")


def duplicate_numeric_keys(typed: DataFrame) -> DataFrame:
    """Numeric variables with more than one value for a subject."""
    keys = ["site_id", "subject_id", "visit_name", "data_label", "category_cd"]
    return typed.where("data_type = 'N'").groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def mixed_visits(landing: DataFrame) -> DataFrame:
    """(category, label, value) combinations seen both with and without a visit."""
    scoped = landing.where(T.has("category_cd", T.VISITNAME) | ~T.has("category_cd", T.DATALABEL))
    return scoped.groupBy("category_cd", "data_label", "data_value").agg(
        F.count_if(F.col("visit_name").isNull()).alias("null_ct"),
        F.count_if(F.col("visit_name").isNotNull()).alias("non_null_ct"),
    ).where("null_ct > 0 and non_null_ct > 0")


def visit_date_report(rows: DataFrame, keys: list[str], date: str, fmt: str = "yyyy/MM/dd HH:mm") -> DataFrame:
    """Keys whose readings do not carry one distinct, well-formed visit date each."""
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(date).alias("n_dates"),
        F.count_if(~T.is_date(date, fmt)).alias("n_bad_dates"),
    ).where("n_rows <> n_dates or n_bad_dates > 0")


def leaf_path(top_node: str) -> Column:
    """Leaf node of a working row by its category template; text values become nodes of their own."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(""))

    path, value = text("category_path"), F.when(F.col("data_type") == "T", text("data_value"))
    with_label = F.replace(path, F.lit(T.DATALABEL), text("data_label"))
    with_visit = F.when(
        T.has(path, T.VISITNAME), F.replace(with_label, F.lit(T.VISITNAME), text("visit_name"))
    ).otherwise(with_label)
    templated = F.concat_ws("\\", with_visit, value)
    plain = F.concat_ws("\\", path, text("data_label"), value, text("visit_name"))
    body = F.when(T.has(path, T.DATALABEL), templated).otherwise(plain)
    return P.collapse(F.concat(F.lit(top_node), body, F.lit("\\")))


def leaf_nodes(typed: DataFrame, top_node: str) -> DataFrame:
    """Distinct leaf nodes: distinct template inputs first, then the path of each."""
    inputs = typed.select(
        "category_cd", "category_path", "visit_name", "data_label", F.when(F.col("data_type") == "T", F.col("data_value")).alias("data_value"), "data_type"
    ).distinct()
    return inputs.select(
        leaf_path(top_node).alias("leaf_node"), "category_cd", "visit_name", "data_label", "data_value", "data_type"
    ).distinct().withColumn("node_name", P.leaf_name("leaf_node"))


def demographics(rows: DataFrame, subject: str = "usubjid") -> DataFrame:
    """Age, sex and race per subject from the label patterns."""
    label = F.upper("data_label")
    value = F.col("data_value")
    age = (label == "AGE") | F.endswith(label, F.lit("(AGE)"))
    sex = label.isin("SEX", "GENDER") | F.endswith(label, F.lit("(SEX)"))
    race = (label == "RACE") | F.endswith(label, F.lit("(RACE)"))
    return rows.groupBy(subject).agg(
        F.coalesce(F.max(F.when(age, F.coalesce(T.to_number(value), F.lit(0.0)))), F.lit(0.0)).try_cast("int").alias("age"),
        F.coalesce(F.max(F.when(sex, value)), F.lit("Unknown")).alias("sex"),
        F.max(F.when(race, value)).alias("race"),
    )


def merge_patients(
    patients: DataFrame, incoming: DataFrame, study: str, in_use: DataFrame | None = None, keep_known: bool = False,
) -> DataFrame:
    """Reload of one study's patients (``patient_num, subject_key, age, sex, race``).

    Subjects no longer delivered go unless a sample still uses them
    (``in_use.patient_num``); known ones are updated, new ones get new ids.
    """
    values = ["age", "sex", "race"]
    mine = F.startswith("subject_key", F.lit(study + ":"))
    gone = patients.where(mine).join(incoming.select("subject_key"), "subject_key", "left_anti")
    if in_use is not None:
        gone = gone.join(in_use.select("patient_num").distinct(), "patient_num", "left_anti")
    kept = patients.join(gone.select("subject_key"), "subject_key", "left_anti")
    merged = upsert(kept, incoming, ["subject_key"], values, ["sex", "race"] if keep_known else [])
    known = merged.join(kept.select("subject_key", "patient_num"), "subject_key")
    fresh = merged.join(kept.select("subject_key"), "subject_key", "left_anti")
    top = patients.agg(F.coalesce(F.max("patient_num"), F.lit(0)).alias("m"))
    numbered = surrogate_ids(fresh, ["subject_key"], "patient_num", top.select("m").scalar())
    columns = ["patient_num", "subject_key", *values]
    return known.select(*columns).unionByName(numbered.select(*columns))


def pedigree_patients(ped: DataFrame, prefix: str, existing: DataFrame | None = None) -> DataFrame:
    """Patients of a pedigree file: coded sex to text, one row per new subject key."""
    # Fragments removed from pedigree individual ids.
    fragments = ["G", "T", "_2", "NA"]
    clean = T.strip(F.col("individual_id"))
    for piece in fragments:
        clean = F.replace(clean, F.lit(piece), F.lit(""))
    out = ped.select(
        F.concat(F.lit(prefix + ":"), clean).alias("subject_key"),
        F.when(F.col("sex_code") == "1", "Male").when(F.col("sex_code") == "2", "Female").otherwise("Unknown").alias("sex"),
    ).groupBy("subject_key").agg(F.min("sex").alias("sex"))
    return out if existing is None else out.join(existing.select("subject_key"), "subject_key", "left_anti")


def without_lower_nodes(nodes: DataFrame, path: str = "leaf_node") -> DataFrame:
    """Leaf nodes that are not an ancestor of another leaf (prefix test as an equi join)."""
    above = nodes.select(F.explode(P.ancestors(path, with_self=False)).alias(path)).distinct()
    return nodes.join(above, path, "left_anti").select(*nodes.columns)


def parent_leaf_conflicts(nodes: DataFrame, path: str = "leaf_node") -> DataFrame:
    """Leaf nodes that are an ancestor of another leaf."""
    above = nodes.select(F.explode(P.ancestors(path, with_self=False)).alias(path)).distinct()
    return nodes.select(path).distinct().join(above, path, "left_semi")


def facts(typed: DataFrame, patients: DataFrame, nodes: DataFrame, concepts: DataFrame, top_node: str) -> DataFrame:
    """Observation facts: one distinct row per patient, concept and value.

    A row's node path follows from the row itself, so repeated readings are
    reduced before any join and each of the two lookups has one key.
    """
    readings = typed.select(
        "usubjid", "study_id", leaf_path(top_node).alias("leaf_node"), F.col("data_type").alias("value_type"), "data_value"
    ).distinct()
    leaves = without_lower_nodes(nodes.select("leaf_node").distinct()).join(
        concepts.select(F.col("concept_path").alias("leaf_node"), "concept_cd"), "leaf_node"
    )
    text = F.col("value_type") == "T"
    found = readings.join(leaves, "leaf_node").join(
        patients.select("patient_num", F.col("subject_key").alias("usubjid")), "usubjid"
    ).select(
        "patient_num", "concept_cd", "study_id", "value_type", F.when(text, F.col("data_value")).otherwise("E").alias("text_value"),
        F.when(~text, T.to_number("data_value")).alias("number_value"),
    )
    # Hardly a fact comes twice here: combined after the shuffle, so that a task holds the join or the groups, not both.
    return found.repartition(*found.columns).distinct()


def load(
    landing: DataFrame, top_node: str, patients: DataFrame, concepts: DataFrame, study: str
) -> dict[str, DataFrame]:
    """The whole clinical load: working rows, nodes, patients, concepts, facts and reports.

    The cleaned rows feed six results; ``infer_types`` has written them to the shared folder.
    """
    typed = infer_types(standardise(landing))
    nodes = leaf_nodes(typed, top_node)
    people = merge_patients(patients, demographics(typed).withColumnRenamed("usubjid", "subject_key"), study)
    fresh = nodes.select(F.col("leaf_node").alias("concept_path"), F.col("node_name").alias("name")).distinct().join(
        concepts.select("concept_path"), "concept_path", "left_anti"
    )
    top = concepts.agg(F.coalesce(F.max("concept_cd"), F.lit(0)).alias("m")).select("m").scalar()
    all_concepts = concepts.select("concept_cd", "concept_path", "name").unionByName(
        surrogate_ids(fresh, ["concept_path"], "concept_cd", top).select("concept_cd", "concept_path", "name")
    )
    return {
        "rows": typed, "nodes": nodes, "patients": people, "concepts": all_concepts,
        "facts": facts(typed, people, nodes, all_concepts, top_node),
        "duplicate_keys": duplicate_numeric_keys(typed), "mixed_visits": mixed_visits(landing),
    }

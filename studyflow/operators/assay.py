"""Assay processing: sample maps, sample nodes, replicate collapse, log and z-score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studyflow.functions import paths as P
from studyflow.functions import stats as S
from studyflow.functions import text as T
from studyflow.operators.grouping import exact_median
from studyflow.operators.joins import null_safe
from studyflow.operators.merge import diff, upsert
from studyflow.operators.numbering import surrogate_ids
from studyflow.session import staged

# Template tokens of a sample category, in node-role order, the
# marker type of expression platforms and the defaults of a sample map.
ROLE_TOKENS = {"PLATFORM": "title", "ATTR1": "attribute_1", "ATTR2": "attribute_2", "TISSUETYPE": "tissue_type"}
GENE_EXPRESSION = "Gene Expression"
DEFAULT_TISSUE = "Unknown"
# end of fixed values


def sample_map_report(samples: DataFrame, platforms: DataFrame, probes: DataFrame) -> DataFrame:
    """Violation counts of a sample map, one row per check."""
    known = platforms.where((F.col("marker_type") == GENE_EXPRESSION) & F.col("title").isNotNull()).select(
        "platform", F.lit(True).alias("__known")
    )
    with_probes = probes.select("platform").distinct().withColumn("__probes", F.lit(True))
    rows = samples.join(known.distinct(), "platform", "left").join(with_probes, "platform", "left")
    checks = {
        "subject_missing": F.col("subject_id").isNull(),
        "sample_missing": F.col("sample_cd").isNull(),
        "platform_missing": F.col("platform").isNull(),
        "tissue_missing": F.col("tissue_type").isNull(),
        "platform_unknown": F.col("__known").isNull(),
        "platform_without_probes": F.col("__probes").isNull(),
        "category_without_platform": ~T.has("category_cd", "PLATFORM"),
    }
    wide = rows.agg(*[F.count_if(c).alias(n) for n, c in checks.items()])
    one_platform = samples.groupBy("sample_cd").agg(
        F.min("platform").alias("a"), F.max("platform").alias("b")
    ).agg(F.count_if(F.col("a") != F.col("b")).alias("n_rows"))
    return wide.unpivot([], list(checks), "check", "n_rows").unionByName(
        one_platform.withColumn("check", F.lit("several_platforms"))
    )


def load_sample_map(landing: DataFrame, source: str, required: list[str], platforms: DataFrame | None = None, marker_type: str = GENE_EXPRESSION) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sample map rows of one source (or of none), the rejects without a required field, and the rows that another load takes.

    With ``platforms`` (platform, marker_type), rows of platforms with another marker type (without case) are skipped too.
    """
    mine = F.coalesce(F.col("source_cd") == source, F.lit(True))
    if platforms is not None:
        kinds = platforms.select("platform", F.upper("marker_type").alias("__kind")).distinct()
        landing = landing.join(kinds, "platform", "left")
        mine = mine & F.coalesce(F.col("__kind") == marker_type.upper(), F.lit(False))
    skipped = landing.where(~mine)
    ready = landing.where(mine).withColumns({
        "study_id": F.upper("study_id"), "tissue_type": F.coalesce("tissue_type", F.lit(DEFAULT_TISSUE)),
    })
    blank = F.lit(False)
    for c in required:
        blank = blank | T.blank_to_null(F.col(c).cast("string")).isNull()
    return tuple(df.drop("__kind") for df in (ready.where(~blank), ready.where(blank), skipped))


def missing_subjects(samples: DataFrame, patients: DataFrame, study: str) -> DataFrame:
    """New subjects a sample map brings in: unknown sex, age 0, no race."""
    keys = samples.where(F.col("subject_id").isNotNull()).select(
        T.subject_key(F.lit(study), "site_id", "subject_id").alias("subject_key")
    ).distinct()
    fresh = keys.join(patients.select("subject_key"), "subject_key", "left_anti")
    top = patients.agg(F.coalesce(F.max("patient_num"), F.lit(0)).alias("m")).select("m").scalar()
    return surrogate_ids(fresh, ["subject_key"], "patient_num", top).select(
        "patient_num", "subject_key", F.lit("Unknown").alias("sex"), F.lit(0).alias("age"), F.lit(None).cast("string").alias("race")
    )


def _fill(template: Column, top_node: str) -> Column:
    for token, column in ROLE_TOKENS.items():
        template = F.replace(template, F.lit(token), F.coalesce(F.col(column), F.lit("")))
    return P.collapse(F.concat(F.lit(top_node), T.category_path(template), F.lit("\\")))


def with_platforms(samples: DataFrame, platforms: DataFrame, marker_type: str = GENE_EXPRESSION) -> DataFrame:
    """Samples with the ``title`` of their platform; platforms of another marker type (without case) or without a title give no rows.

    ``platforms``: platform, title, marker_type. A platform listed twice counts once, by its least title.
    """
    kind = F.upper("marker_type") == marker_type.upper()
    titles = platforms.where(kind & T.blank_to_null("title").isNotNull()).groupBy("platform").agg(F.min("title").alias("title"))
    return samples.drop("title").join(titles, "platform")


def node_roles(samples: DataFrame, top_node: str) -> DataFrame:
    """One row per sample row and node role, with the node path of that role.

    A role node is the category template cut after the role's token and
    filled from the sample, so it needs no join to be found again.
    """
    template = F.col("category_cd")

    def role(name: str, cut: Column, needed: Column) -> Column:
        return F.struct(F.lit(name).alias("role"), F.when(needed, _fill(cut, top_node)).alias("node_path"))

    variants = [role("LEAF", template, F.lit(True))]
    for token, column in ROLE_TOKENS.items():
        present = T.has(template, token) & F.col(column).isNotNull()
        variants.append(role(token, T.cut_after(template, token, len(token)), present))
    return samples.select("*", F.inline(F.array(*variants))).where(F.col("node_path").isNotNull())


def sample_nodes(samples: DataFrame, top_node: str, platforms: DataFrame | None = None, marker_type: str = GENE_EXPRESSION) -> DataFrame:
    """Distinct sample nodes by role (distinct template inputs first, then expansion); with ``platforms`` the titles come from there."""
    if platforms is not None:
        inputs = samples.select("category_cd", "platform", *[c for c in ROLE_TOKENS.values() if c != "title"]).distinct()
        samples = with_platforms(inputs, platforms, marker_type)
    inputs = samples.select("category_cd", *ROLE_TOKENS.values()).distinct()
    nodes = node_roles(inputs, top_node).select("node_path", "role").distinct()
    return nodes.withColumn("name", P.leaf_name("node_path"))


def sample_mapping(
    samples: DataFrame, patients: DataFrame, concepts: DataFrame, study: str, top_node: str
) -> DataFrame:
    """Samples with patient and the concept of every node role.

    Role nodes depend on the template inputs only: they are expanded and looked
    up once per distinct input, and the samples meet that table in one join.
    """
    inputs = ["category_cd", *ROLE_TOKENS.values()]
    found = node_roles(samples.select(*inputs).distinct(), top_node).join(
        concepts.select(F.col("concept_path").alias("node_path"), "concept_cd"), "node_path"
    )
    codes = found.groupBy(*inputs).agg(
        *[F.max(F.when(F.col("role") == r, F.col("concept_cd"))).alias(f"{r.lower()}_cd") for r in ("LEAF", *ROLE_TOKENS)]
    ).where("leaf_cd is not null and platform_cd is not null")
    kept = samples.select("site_id", "subject_id", "sample_cd", "platform", *inputs).distinct()
    keyed = null_safe(kept, codes, inputs).drop("title").withColumn(
        "subject_key", T.subject_key(F.lit(study), "site_id", "subject_id")
    )
    return keyed.join(patients.select("subject_key", "patient_num"), "subject_key").withColumn(
        "data_uid", F.concat_ws("-", F.col("leaf_cd").cast("string"), F.col("patient_num").cast("string"))
    )


def refresh_mapping(known: DataFrame, delivered: DataFrame, keys: tuple[str, ...] = ("subject_key", "sample_cd", "platform")) -> DataFrame:
    """The sample mapping after a reload: known samples take the delivered patient, concepts and attributes, new ones are added, others stay.

    ``change`` says which: ``changed``, ``identical``, ``new`` or ``kept``.
    """
    values = [c for c in known.columns if c not in keys]
    merged = upsert(known, delivered, list(keys), values)
    state = diff(known, delivered, list(keys), values, "change").select(*keys, F.when(F.col("change") == "deleted", "kept").otherwise(F.col("change")).alias("change"))
    return merged.join(state, list(keys))


def all_loaded(samples: DataFrame, mapping: DataFrame) -> DataFrame:
    """Count check: every sample row must be mapped."""
    n_map = mapping.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return samples.agg(F.count(F.lit(1)).alias("n_samples")).withColumn("n_mapped", n_map).withColumn(
        "complete", F.col("n_samples") == F.col("n_mapped")
    )


def keep_delivered(mapping: DataFrame, samples: DataFrame, keys: list[str]) -> DataFrame:
    """Drop mappings that a reload no longer delivers (null keys match)."""
    return null_safe(mapping, samples.select(*keys).distinct(), keys, "left_semi")


def sample_facts(mapping: DataFrame, study: str) -> DataFrame:
    return mapping.select(
        "patient_num", F.col("leaf_cd").alias("concept_cd"), F.lit(study).alias("study_id"),
        F.lit("T").alias("value_type"), F.lit("E").alias("text_value"),
    ).distinct()


def node_types(nodes: DataFrame, tree: DataFrame, path: str = "path") -> DataFrame:
    """A node that is a leaf in any role becomes a sample leaf, the rest of them folders."""
    kinds = nodes.groupBy(F.col("node_path").alias(path)).agg(F.min(F.when(F.col("role") == "LEAF", 0).otherwise(1)).alias("__k"))
    return tree.join(kinds, path, "left").withColumns({
        "attributes": F.when(F.col("__k") == 0, "LAH").when(F.col("__k") == 1, "FA").otherwise(F.col("attributes")),
        "data_type": F.when(F.col("__k").isNotNull(), "T").otherwise(F.col("data_type")),
    }).select(*tree.columns)


def collapse_replicates(
    values: DataFrame, keys: list[str], value: str, data_type: str = "R", out: str = "intensity"
) -> DataFrame:
    """Mean of the replicates at four decimals; raw data only counts above zero."""
    exact = values.withColumn("__v", F.col(value).try_cast("decimal(18,4)"))
    if data_type == "R":
        exact = exact.where("__v > 0")
    return exact.groupBy(*keys).agg((F.sum("__v").cast("double") / F.count("__v")).alias(out))


def log_transform(df: DataFrame, value: str, data_type: str = "R", base: float = 2) -> DataFrame:
    """Raw and log intensity by the delivered value type."""
    x = F.col(value)
    if data_type == "R":
        raw, log = x, S.log_base(x, base)
    else:
        raw = F.lit(0.0) if base == -1 else F.round(F.pow(F.lit(float(base)), x), 4)
        log = x if data_type == "L" else S.log_base(x, base)
    return df.withColumns({"raw_intensity": raw, "log_intensity": log})


def zscore(
    df: DataFrame, group: list[str], value: str = "log_intensity", clamp: float = S.Z_CLAMP, out: str = "zscore",
) -> DataFrame:
    """Median-centred z-score per group, clamped. The rows are written once for the median, the spread and the join."""
    df = staged(df, "values")
    spread = {"__sd": F.stddev_samp(value)}
    stats = exact_median(df, group, value, "__median", spread)
    joined = df.join(stats, group)
    return joined.withColumn(out, S.zscore(F.col(value), F.col("__median"), F.col("__sd"), clamp)).drop("__median", "__sd")


def process(
    samples: DataFrame, values: DataFrame, probes: DataFrame, data_type: str = "R", log_base: float = 2,
    clamp: float = S.Z_CLAMP,
) -> DataFrame:
    """Sample map ⋈ values ⋈ probes -> collapsed, logged and scored rows.

    ``samples``: sample_cd, assay_id, platform; ``values``: probeset,
    sample_cd, intensity; ``probes``: platform, probeset, probeset_id.
    """
    joined = values.join(samples.select("sample_cd", "assay_id", "platform"), "sample_cd").join(
        probes.select("platform", "probeset", "probeset_id"), ["platform", "probeset"]
    )
    flat = collapse_replicates(joined, ["probeset_id", "assay_id"], "intensity", data_type)
    if data_type == "T":
        return flat.select(
            "probeset_id", "assay_id", F.lit(None).cast("double").alias("raw_intensity"),
            F.col("intensity").alias("log_intensity"), S.clamp(F.col("intensity"), clamp).alias("zscore"),
        )
    logged = log_transform(flat, "intensity", data_type, log_base).drop("intensity")
    return zscore(logged, ["probeset_id"], clamp=clamp)


def append_samples(existing: DataFrame, incoming: DataFrame, keys: list[str], group: list[str], **options) -> DataFrame:
    """Incremental matrix load: add the new samples, then score the whole study again; ``existing`` is read twice: give written rows."""
    fresh = incoming.join(existing.select(*keys), keys, "left_anti")
    columns = [c for c in existing.columns if c != "zscore"]
    return zscore(existing.select(*columns).unionByName(fresh.select(*columns)), group, **options)

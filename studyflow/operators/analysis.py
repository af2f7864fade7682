"""Differential-analysis results: import, normalised p-values, heat maps and tagging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studyflow.functions import stats as S
from studyflow.functions import text as T
from studyflow.functions.paths import split_list
from studyflow.operators.joins import no_case
from studyflow.operators.numbering import surrogate_ids
from studyflow.session import staged

# Filters of the stored result tables, the assay kind without
# normalised p-values and the correlation types of the heat map.
MIN_FOLD_CHANGE, MAX_PVALUE, MAX_NPV = 1.0, 0.1, 0.05
UNSCORED_TYPE = "RBM"
TERM_ALIASES = {("study_design", "Clinical"): "Clinical Trial"}
GENE_CORRELATIONS = ["GENE", "HOMOLOGENE_GENE", "PROTEIN TO GENE"]
# end of fixed values


def import_external(rows: DataFrame, study: str = "study_id") -> DataFrame:
    """Strip quotes everywhere, upper-case the study, drop rows without any content."""
    bare = rows.withColumns({c: T.blank_to_null(F.replace(F.col(c), F.lit('"'), F.lit(""))) for c in rows.columns})
    content = F.coalesce(*[F.col(c) for c in rows.columns if c != study])
    return bare.where(content.isNotNull()).withColumn(study, F.upper(study))


def clean_vendor(rows: DataFrame, numbers: list[str]) -> DataFrame:
    """Vendor marks for missing numbers become null."""
    return rows.withColumns({c: T.to_number(T.missing_to_null(c)) for c in numbers})


def validate_results(rows: DataFrame) -> DataFrame:
    """Rows with a numeric p-value and fold change; other bad numbers are nulled, lsmeans ordered."""
    usable = rows.where(T.is_numeric("preferred_pvalue") & T.is_numeric("fold_change"))
    one, two = T.to_number("lsmean_1"), T.to_number("lsmean_2")
    both = one.isNotNull() & two.isNotNull()
    return usable.withColumns({
        "fold_change": T.to_number("fold_change"), "preferred_pvalue": T.to_number("preferred_pvalue"),
        "raw_pvalue": T.to_number("raw_pvalue"), "adjusted_pvalue": T.to_number("adjusted_pvalue"),
        "min_lsmean": F.when(both, F.least(one, two)), "max_lsmean": F.when(both, F.greatest(one, two)),
    }).drop("lsmean_1", "lsmean_2")


def dropped_results(rows: DataFrame) -> DataFrame:
    """How many rows lack a numeric p-value or fold change."""
    good = F.coalesce(T.is_numeric("preferred_pvalue") & T.is_numeric("fold_change"), F.lit(False))
    return rows.agg(F.count_if(~good).alias("n_dropped"), F.count(F.lit(1)).alias("n_read"))


def load(results: DataFrame, analyses: DataFrame) -> DataFrame:
    """Validated results of registered analyses (id matched without case)."""
    return no_case(validate_results(results), analyses, "analysis_id", "analysis_cd").drop("analysis_cd")


def add_npv(
    results: DataFrame, group: list[str], fold_change: str = "fold_change", skip: Column | None = None, out: str = "npv"
) -> DataFrame:
    """Normalised p-value from the mean and spread of the fold changes of each analysis."""
    fc = F.col(fold_change)
    scored = results if skip is None else results.where(~skip)
    stats = scored.where(fc.isNotNull()).groupBy(*group).agg(F.avg(fc).alias("__mu"), F.stddev_samp(fc).alias("__sd"))
    joined = results.join(stats, group, "left")
    return S.with_npv(joined, fc, F.col("__mu"), F.col("__sd"), out).drop("__mu", "__sd")


def vendor_npv(results: DataFrame, group: list[str], fold_change: str = "fold_change", digits: int = 4) -> DataFrame:
    """The vendor variant: rounded statistics, analyses without spread left out, rounded result."""
    fc = F.col(fold_change)
    stats = results.groupBy(*group).agg(
        F.round(F.avg(fc), digits).alias("fc_mean"), F.round(F.stddev_samp(fc), digits).alias("fc_stddev"), F.count(F.lit(1)).alias("data_ct")
    ).where("fc_stddev > 0")
    scored = S.with_npv(results.join(stats, group), fc, F.col("fc_mean"), F.col("fc_stddev"))
    return scored.withColumn("npv", F.round("npv", digits))


def significant_results(results: DataFrame) -> DataFrame:
    return results.where((F.abs("fold_change") >= MIN_FOLD_CHANGE) & (F.col("pvalue").isNull() | (F.col("pvalue") <= MAX_PVALUE)))


def tea_results(results: DataFrame) -> DataFrame:
    return results.where(F.col("npv") <= MAX_NPV)


def marker_counts(results: DataFrame, links: DataFrame, analysis: str = "analysis_id", feature: str = "probeset") -> DataFrame:
    """Distinct markers per analysis under both filters, in one pass."""
    marked = results.join(links, feature)
    plain = (F.abs("fold_change") >= MIN_FOLD_CHANGE) & (F.col("pvalue").isNull() | (F.col("pvalue") <= MAX_PVALUE))
    pairs = marked.groupBy(analysis, "marker_id").agg(
        F.bool_or(F.coalesce(plain, F.lit(False))).alias("a"), F.bool_or(F.coalesce(F.col("npv") <= MAX_NPV, F.lit(False))).alias("b")
    )
    return pairs.groupBy(analysis).agg(F.count_if("a").alias("n_markers"), F.count_if("b").alias("n_tea_markers"))


def feature_groups(probes: DataFrame, existing: DataFrame) -> DataFrame:
    """Probe names that are not feature groups yet."""
    return probes.select(F.col("probeset").alias("feature")).subtract(existing.select("feature"))


def feature_markers(annotation: DataFrame, markers: DataFrame) -> DataFrame:
    """Feature -> marker links by symbol and organism."""
    side = markers.select(F.upper("symbol").alias("__s"), F.upper("organism").alias("__o"), "marker_id")
    keyed = annotation.withColumns({"__s": F.upper("gene_symbol"), "__o": F.upper("organism")})
    return keyed.join(side, ["__s", "__o"]).select(F.col("probeset").alias("feature"), "marker_id").distinct()


def significance(fc: Column, pvalue: Column, npv: Column, mean_1: Column, mean_2: Column, fc_cut: Column, p_cut: Column, mean_cut: Column) -> Column:
    """1 where fold change, p-value (or its fallback) and a group mean pass their cutoffs."""
    change = fc.isNull() | (F.abs(fc) > fc_cut)
    probable = F.coalesce(pvalue, npv) < p_cut
    large = (mean_1.isNull() & mean_2.isNull()) | (mean_1 > mean_cut) | (mean_2 > mean_cut)
    return F.when(change & probable & large, 1).otherwise(0)


def heat_map(
    intensities: DataFrame, cohort_samples: DataFrame, analysis_cohorts: DataFrame, analyses: DataFrame, results: DataFrame,
    probes: DataFrame, samples: DataFrame, feature_marker: DataFrame, markers: DataFrame, keywords: DataFrame, correlations: DataFrame,
) -> DataFrame:
    """Sample intensities of every analysis cohort next to the analysis result of their probe.

    Only markers with a correlation (marker_id, kind) of one of ``GENE_CORRELATIONS`` are on the map.

    Both sides take their cohort from the small link tables first; one join on
    (study, cohort, probe) then gives exactly the rows of the map, with no
    intermediate of all analyses times all samples.
    """
    assays = cohort_samples.join(samples.select("assay_id", "study_id", "subject_id"), ["study_id", "assay_id"])
    measured = intensities.join(probes.select("probeset_id", "probeset"), "probeset_id").join(assays, "assay_id")
    related = correlations.where(F.col("kind").isin(GENE_CORRELATIONS)).select("marker_id")
    named = (
        feature_marker.join(related, "marker_id", "left_semi").join(markers.select("marker_id", "marker_name", "gene_id"), "marker_id")
        .join(keywords.select("marker_id", "keyword_id"), "marker_id").withColumnRenamed("feature", "probeset")
    )
    cutoffs = analyses.select("analysis_id", "fc_cutoff", "p_cutoff", "mean_cutoff").join(analysis_cohorts, "analysis_id")
    scored = results.join(cutoffs, "analysis_id").join(named, "probeset").withColumn(
        "significant",
        significance(
            F.col("fold_change"), F.col("pvalue"), F.col("npv"), F.col("min_lsmean"), F.col("max_lsmean"),
            F.col("fc_cutoff"), F.col("p_cutoff"), F.col("mean_cutoff"),
        ),
    )
    return measured.join(scored, ["study_id", "cohort_id", "probeset"]).select(
        "study_id", "analysis_id", "cohort_id", "subject_id", "assay_id", "probeset", "log_intensity", "fold_change", "pvalue",
        "npv", "marker_id", "marker_name", "gene_id", "keyword_id", "significant",
    )


def cross_trial(heat: DataFrame, keywords: DataFrame, markers: DataFrame) -> DataFrame:
    """Distinct cross-study summary without the sample level, with the organism of the marker."""
    kinds = markers.select("marker_id", "organism")
    return heat.join(kinds, "marker_id").join(keywords.select("keyword_id", F.upper("keyword").alias("keyword")), "keyword_id").select(
        "analysis_id", "keyword_id", "keyword", "marker_id", "marker_name", "gene_id", "probeset", "fold_change", "pvalue", "organism"
    ).distinct()


def cohort_links(analyses: DataFrame, column: str = "cohorts", keys: tuple[str, ...] = ("study_id", "analysis_id")) -> DataFrame:
    """Analysis <-> cohort rows from ``;`` lists."""
    items = analyses.select(*keys, F.explode(split_list(column, ";")).alias("cohort_id")).withColumn("cohort_id", T.strip("cohort_id"))
    return items.where("cohort_id <> ''").withColumn("study_id", F.upper("study_id")).distinct()


def melt_terms(records: DataFrame, ids: list[str], columns: dict[str, str | None]) -> DataFrame:
    """(ids, category, term) rows of several attribute columns in one pass; a column may be a list."""
    cells = [
        F.struct(F.lit(c).alias("category"), (split_list(c, sep) if sep else F.array(F.col(c))).alias("terms"))
        for c, sep in columns.items()
    ]
    rows = records.select(*ids, F.explode(F.array(*cells)).alias("__c")).select(*ids, "__c.category", F.explode("__c.terms").alias("term"))
    return rows.withColumn("term", T.strip("term")).where("term <> ''")


def tag_terms(
    records: DataFrame, ids: list[str], columns: dict[str, str | None], taxonomy: DataFrame, study: str = "study_id"
) -> tuple[DataFrame, DataFrame]:
    """Tags of matched terms (``ids``, term_id, source) and the report of unmatched ones.

    Terms with an alias are looked up under it (``TERM_ALIASES``, by category); the source keeps the given text.
    The vocabulary is broadcast, never the terms, whose number grows with the records. Equal tags are those of one record, so they are combined after the
    shuffle only.
    """
    terms = melt_terms(records, ids, columns).withColumn("__k", F.upper("term"))
    for (category, alias), name in TERM_ALIASES.items():
        terms = terms.withColumn("__k", F.when((F.col("category") == category) & (F.col("__k") == alias.upper()), name.upper()).otherwise(F.col("__k")))
    known = F.broadcast(taxonomy.select(F.upper("term_name").alias("__k"), "term_id"))
    tags = terms.join(known, "__k").select(
        *ids, "term_id", F.upper(F.concat_ws(":", "category", "term")).alias("source")
    )
    tags = tags.repartition(*tags.columns).distinct()
    invalid = terms.join(known, "__k", "left_anti").select(F.upper(study).alias("study_id"), "category", "term").distinct()
    return tags, invalid


def lineage(taxonomy: DataFrame, relations: DataFrame, tags: DataFrame) -> DataFrame:
    """Tags of the terms and of all their ancestors, with the term's name and, where the taxonomy has one, its search keyword.

    Levels of the taxonomy are added until none brings a new (term, ancestor)
    pair, so a cycle ends too; each round runs as a job of its own. The tags
    then meet the closed pairs in one join.
    """
    edges = relations.select(F.col("child_id").alias("__at"), F.col("parent_id").alias("__up")).distinct()
    fresh = staged(tags.select("term_id").distinct().select("term_id", F.col("term_id").alias("up")), "lineage")
    pairs = fresh
    while not fresh.isEmpty():
        above = fresh.join(edges, F.col("up") == F.col("__at")).select("term_id", F.col("__up").alias("up")).distinct()
        fresh = staged(above.join(pairs, ["term_id", "up"], "left_anti"), "lineage")
        pairs = pairs.unionByName(fresh)
    found = tags.join(pairs, "term_id").drop("term_id").withColumnRenamed("up", "term_id").select(*tags.columns).distinct()
    known = [c for c in ("term_name", "search_keyword_id") if c in taxonomy.columns]
    return found.join(taxonomy.select("term_id", *known), "term_id")


def refresh_entries(old: DataFrame, new: DataFrame, keys: list[str], values: list[str]) -> tuple[DataFrame, DataFrame]:
    """Refreshed analysis entries and the count check against the delivery."""
    from studyflow.operators.merge import apply, diff

    entries = apply(diff(old, new, keys, values))
    n_new = new.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    check = entries.agg(F.count(F.lit(1)).alias("n_entries")).withColumn("n_delivered", n_new).withColumn(
        "complete", F.col("n_entries") == F.col("n_delivered")
    )
    return entries, check


def project_rows(lines: DataFrame, names: list[str], study: str = "file_name", line: str = "line") -> DataFrame:
    """``key=value`` project lines to one row per study; ``.`` is missing."""
    pairs = lines.where(F.contains(line, F.lit("="))).select(
        study, T.strip(F.substring_index(line, "=", 1)).alias("key"),
        T.missing_to_null(F.expr(f"substring({line}, locate('=', {line}) + 1)"), (".",)).alias("value"),
    )
    return pairs.groupBy(study).agg(*[F.max(F.when(F.col("key") == n, F.col("value"))).alias(n) for n in names])


def platform_rows(rows: DataFrame, lists: dict[str, str], ids: list[str]) -> DataFrame:
    """Parallel ``;`` lists of a project (platform names, vendors, organisms …) to distinct rows."""
    zipped = F.arrays_zip(*[split_list(c, ";").alias(n) for c, n in lists.items()])
    return rows.select(*ids, F.explode(zipped).alias("__z")).select(
        *ids, *[T.strip(F.col("__z").getField(n)).alias(n) for n in lists.values()]
    ).distinct()


def _added(known: DataFrame, rows: DataFrame, key: list[str], out: str, more: list[str]) -> DataFrame:
    """``known`` and the rows with new keys, numbered after the greatest id; written once, as later steps resolve their keys in it."""
    values = [F.max(c).alias(c) for c in more]
    distinct = rows.groupBy(*key).agg(*values) if values else rows.select(*key).distinct()
    fresh = distinct.join(known.select(*key), key, "left_anti")
    top = known.agg(F.coalesce(F.max(out), F.lit(0)).alias("m")).select("m").scalar()
    columns = [out, *key, *more]
    return staged(known.select(*columns).unionByName(surrogate_ids(fresh, key, out, top).select(*columns)), out)


def load_project(rows: DataFrame, known: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The dependent entities of a project file, in the order in which they need each other's ids.

    ``rows`` (one for each analysis of a project): accession, title, analysis, dataset, and ``;`` lists compounds and diseases. ``known`` holds the
    tables so far: experiment (experiment_id, accession, title), analysis (analysis_id, experiment_id, analysis), dataset (dataset_id, analysis_id,
    dataset), compound (compound_id, name) and disease (disease_id, name); a compound may have several names. Gives the first three with the new
    rows, the links experiment_compound and experiment_disease, and ``rejects`` (step, accession, value): rows without an accession or an analysis
    and names that no vocabulary knows. Loaded again, nothing is added.
    """
    clean = rows.select(F.upper(T.blank_to_null("accession")).alias("accession"), *[T.blank_to_null(c).alias(c) for c in ("title", "analysis", "dataset", "compounds", "diseases")])
    there = clean.where("accession is not null")
    experiment = _added(known["experiment"], there, ["accession"], "experiment_id", ["title"])
    resolved = there.join(experiment.select("accession", "experiment_id"), "accession")
    analysis = _added(known["analysis"], resolved.where("analysis is not null"), ["experiment_id", "analysis"], "analysis_id", [])
    of_analysis = resolved.where("dataset is not null").join(analysis, ["experiment_id", "analysis"], "left")
    dataset = _added(known["dataset"], of_analysis.where("analysis_id is not null"), ["analysis_id", "dataset"], "dataset_id", [])
    rejects = [
        clean.where("accession is null").select(F.lit("experiment").alias("step"), "accession", F.coalesce("analysis", "title").alias("value")),
        of_analysis.where("analysis_id is null").select(F.lit("dataset").alias("step"), "accession", F.col("dataset").alias("value")),
    ]
    links = {}
    for kind in ("compound", "disease"):
        named = resolved.select("accession", "experiment_id", F.explode(split_list(f"{kind}s", ";")).alias("value")).withColumn("value", T.strip("value")).where("value <> ''").distinct()
        vocabulary = known[kind].select(F.lower(T.strip("name")).alias("__name"), f"{kind}_id").distinct()
        met = named.join(vocabulary, F.lower("value") == F.col("__name"), "left")
        links[f"experiment_{kind}"] = met.where(f"{kind}_id is not null").select("experiment_id", f"{kind}_id").distinct()
        rejects.append(met.where(f"{kind}_id is null").select(F.lit(kind).alias("step"), "accession", "value"))
    refused = rejects[0]
    for more in rejects[1:]:
        refused = refused.unionByName(more)
    return {"experiment": experiment, "analysis": analysis, "dataset": dataset, **links, "rejects": refused.distinct()}

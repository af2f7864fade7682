"""Vocabularies, pathways and study metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studyflow.functions import text as T
from studyflow.functions.paths import nth, split_list
from studyflow.operators.merge import upsert
from studyflow.operators.reshape import rows_to_columns

# Record separators and field patterns of the vocabulary files,
# and the pathways that are not part of the definition files.
MESH_RECORD, TERM_RECORD, PATHWAY_RECORD = "*NEWRECORD", "[Term]", "ING:"
MESH_FIELD = r"(?m)^{name} = ([^\r\n]*)"
MESH_ENTRY = r"(?m)^ENTRY = ([^|\r\n]*)"
EXTRA_PATHWAYS = {
    "hsa01100": "Metabolic pathways", "hsa05131": "Shigellosis", "hsa05200": "Pathways in cancer",
}
# end of fixed values


def read_records(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """Multi-line records of a text file, split at the separator by the scan itself."""
    return spark.read.option("lineSep", separator).text(path).select(F.col("value").alias("record"))


def mesh_headings(records: DataFrame, trees: list[str] | None = None) -> DataFrame:
    """Descriptors (ui, mh, mn); with ``trees`` only those under one of the tree numbers."""
    numbers = F.regexp_extract_all("record", F.lit(MESH_FIELD.format(name="MN")), F.lit(1))
    rows = records.select(
        T.strip(F.regexp_extract("record", MESH_FIELD.format(name="UI"), 1)).alias("ui"),
        T.strip(F.regexp_extract("record", MESH_FIELD.format(name="MH"), 1)).alias("mh"),
        T.strip(F.coalesce(F.try_element_at(numbers, F.lit(-1)), F.lit(""))).alias("mn"), numbers.alias("__all"),
    ).where("ui <> '' and mh <> ''")
    if trees:
        def wanted(n: Column) -> Column:
            test = F.lit(False)
            for t in trees:
                test = test | F.startswith(n, F.lit(t))
            return test

        rows = rows.where(F.exists("__all", wanted))
    return rows.drop("__all")


def mesh_synonyms(records: DataFrame) -> DataFrame:
    """(mh, entry) rows; an entry ends at its first bar."""
    return records.select(
        T.strip(F.regexp_extract("record", MESH_FIELD.format(name="MH"), 1)).alias("mh"),
        F.explode(F.regexp_extract_all("record", F.lit(MESH_ENTRY), F.lit(1))).alias("entry"),
    ).select("mh", T.strip("entry").alias("entry"))


def ontology_terms(records: DataFrame) -> DataFrame:
    """Ids and names of term blocks."""
    return records.select(
        T.strip(F.regexp_extract("record", r"(?m)^id: ([^\r\n]*)", 1)).alias("term_id"),
        T.strip(F.regexp_extract("record", r"(?m)^name: ([^\r\n]*)", 1)).alias("term_name"),
    ).where("term_id <> '' and term_name <> ''")


def gene_associations(lines: DataFrame, genes: DataFrame, organism: str, line: str = "line") -> tuple[DataFrame, DataFrame]:
    """(term, gene) associations of known genes, and the rejects."""
    pairs = lines.where(~F.contains(line, F.lit("!"))).select(
        T.strip(nth(line, 5, "\t")).alias("term_id"), T.strip(nth(line, 3, "\t")).alias("symbol")
    ).distinct()
    known = genes.select("symbol", "gene_id")
    result = pairs.join(known, "symbol").select("term_id", "gene_id", "symbol", F.lit(organism).alias("organism"))
    return result, pairs.join(known, "symbol", "left_anti")


def gene_info(lines: DataFrame, taxa: list[str], line: str = "line") -> tuple[DataFrame, DataFrame]:
    """Genes of the listed taxa and their synonyms (``|`` list, ``-`` for none)."""
    fields = {"tax_id": 1, "gene_id": 2, "symbol": 3, "synonyms": 5, "description": 9}
    body = lines.where(~F.startswith(line, F.lit("#"))).select(*[nth(line, i, "\t").alias(n) for n, i in fields.items()])
    mine = body.where(F.col("tax_id").isin(taxa))
    synonyms = mine.where("synonyms <> '-'").select(
        "tax_id", "gene_id", "symbol", F.explode(split_list("synonyms", "|")).alias("synonym")
    ).where(T.strip("synonym") != "")
    return mine.drop("synonyms"), synonyms


def taxonomy_names(lines: DataFrame, name_class: str | None = None, line: str = "line") -> DataFrame:
    """Names of a taxonomy dump (``|`` fields), of one name class or all."""
    fields = ["tax_id", "name", "unique_name", "name_class"]
    rows = lines.select(*[T.strip(nth(line, i, "|")).alias(n) for i, n in enumerate(fields, 1)])
    return rows if name_class is None else rows.where(F.col("name_class") == name_class)


def pathway_genes(lines: DataFrame, prefix: str = "hsa:", line: str = "line") -> DataFrame:
    """(pathway, gene id, symbol) from three-column pathway lines."""
    def plain(n: int, drop: str) -> Column:
        return F.replace(nth(line, n, "\t"), F.lit(drop), F.lit(""))

    return lines.where(F.size(split_list(line, "\t")) > 2).select(
        plain(1, "path:").alias("pathway"), plain(2, prefix).alias("gene_id"), nth(plain(3, prefix), 1, " ").alias("symbol")
    )


def pathway_definitions(lines: DataFrame, extra: dict[str, str] | None = None, line: str = "line") -> DataFrame:
    """(pathway, title) of definition lines plus the pathways that must be added."""
    text = nth(line, 3, "\t")
    named = lines.where(~F.contains(line, F.lit("hsa:")) & F.contains(line, F.lit("?hsa"))).select(
        nth(text, 1, ": ").alias("pathway"), nth(text, 2, ": ").alias("title")
    )
    extra = EXTRA_PATHWAYS if extra is None else extra
    return named.unionByName(lines.sparkSession.createDataFrame(list(extra.items()), "pathway string, title string"))


def pathway_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of a pathway file. Only a marker at the start of a line begins one; the file's first needs no line end before it."""
    records = read_records(spark, path, f"\n{PATHWAY_RECORD}")
    first = F.startswith("record", F.lit(PATHWAY_RECORD))
    return records.select(F.when(first, F.substring("record", len(PATHWAY_RECORD) + 1, 2**30)).otherwise(F.col("record")).alias("record"))


def gene_list_pathways(records: DataFrame, genes: DataFrame, record: str = "record") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pathway rows whose gene list may span lines: (definitions, members, rejects)."""
    joined = F.regexp_replace(record, r"[\r\n]+", "")
    rows = records.where(T.strip(record) != "").select(
        F.concat(F.lit(PATHWAY_RECORD), nth(joined, 1, "\t")).alias("pathway"),
        T.strip(F.replace(nth(joined, 2, "\t"), F.lit(","), F.lit(""))).alias("title"),
        F.replace(nth(joined, 5, "\t"), F.lit('"'), F.lit("")).alias("genes"),
    )
    members = rows.select("pathway", F.explode(F.split("genes", " +")).alias("gene_id")).withColumn(
        "gene_id", T.strip(F.replace("gene_id", F.lit(","), F.lit("")))
    ).where("gene_id <> ''")
    known = genes.select("gene_id", "symbol")
    return rows.select("pathway", "title"), members.join(known, "gene_id"), members.join(known, "gene_id", "left_anti")


def correlations(pathway_gene: DataFrame, pathways: DataFrame, markers: DataFrame, existing: DataFrame, kind: str) -> DataFrame:
    """Pathway -> gene marker edges matched without case and by organism, minus the known ones."""
    paths = pathways.select(F.upper("pathway").alias("__p"), "pathway_id", F.upper("organism").alias("__o"))
    sides = markers.select(F.upper("symbol").alias("__s"), F.upper("organism").alias("__o"), "marker_id")
    edges = pathway_gene.select(F.upper("pathway").alias("__p"), F.upper("symbol").alias("__s")).distinct().join(
        paths, "__p").join(sides, ["__s", "__o"]).select("pathway_id", "marker_id", F.lit(kind).alias("kind"))
    return edges.distinct().join(existing.select("pathway_id", "marker_id"), ["pathway_id", "marker_id"], "left_anti")


def observations(lines: DataFrame, default_source: str, line: str = "line") -> tuple[DataFrame, DataFrame]:
    """Observation dictionary (name, code, description, type, source) and its synonyms."""
    bare = lines.withColumn("__l", F.replace(line, F.lit('"'), F.lit("")))
    fields = {"name": 1, "code": 2, "description": 3, "type": 4, "source": 5, "synonym": 6}
    rows = bare.select(*[T.blank_to_null(nth("__l", i, "\t")).alias(n) for n, i in fields.items()]).withColumn(
        "source", F.coalesce("source", F.lit(default_source))
    )
    unique = rows.where("name is not null").groupBy("name").agg(
        F.max_by(F.struct("code", "description", "type", "source"), F.struct("code", "description", "type", "source")).alias("r")
    ).select("name", "r.*")
    return unique, rows.where("synonym is not null").select("code", "type", "source", "synonym").distinct()


def metadata_row(pairs: DataFrame, names: list[str], required: list[str], ids: list[str]) -> tuple[DataFrame, DataFrame]:
    """Key/value metadata to one row per study, and the report of missing required fields."""
    wide = rows_to_columns(pairs, ids, "column_name", "value", names)
    gaps = F.concat_ws(",", *[F.when(T.blank_to_null(c).isNull(), c) for c in required])
    report = wide.select(*ids, gaps.alias("missing_fields")).where("missing_fields <> ''")
    return wide, report


def overall_design(end_points: Column, inclusion: Column, exclusion: Column, fallback: Column, length: int | None = None) -> Column:
    """Concatenated design text without ``N/A`` parts, whole unless a length is given."""
    def part(c: Column, prefix: str) -> Column:
        return F.when(c != "N/A", F.concat(F.lit(prefix), c)).otherwise("")

    text = F.concat(
        F.coalesce(part(end_points, ""), F.lit("")), F.coalesce(part(inclusion, " Inclusion Criteria: "), F.lit("")),
        F.coalesce(part(exclusion, " Exclusion Criteria: "), F.lit("")),
    )
    return F.coalesce(F.nullif(text if length is None else F.substring(text, 1, length), F.lit("")), fallback)


def typed_metadata(landing: DataFrame, dates: list[str], numbers: list[str]) -> DataFrame:
    """``YYYYMMDD`` dates and numbers, null where malformed."""
    return landing.withColumns({
        **{c: F.try_to_timestamp(F.when(F.rlike(c, F.lit("^[0-9]{8}$")), F.col(c)), F.lit("yyyyMMdd")).cast("date") for c in dates},
        **{c: T.to_number(c) for c in numbers},
    })


def upsert_metadata(known: DataFrame, landing: DataFrame, key: str, dates: list[str], numbers: list[str], texts: dict[str, int | None]) -> DataFrame:
    """Study metadata after a delivery: typed as in ``typed_metadata``, texts trimmed and cut to their length, known studies updated, new ones added.

    A delivered null empties the field, as the delivery is the whole row. Of several rows of a study the greatest counts; rows without a key are left out.
    """
    cut = {c: T.strip(c) if n is None else F.substring(T.strip(c), 1, n) for c, n in texts.items()}
    values = [*dates, *numbers, *texts]
    typed = typed_metadata(landing.where(T.blank_to_null(key).isNotNull()), dates, numbers).withColumns(cut)
    row = F.struct(*values)
    single = typed.groupBy(key).agg(F.max(row).alias("__r")).select(key, "__r.*")
    return upsert(known, single, [key], values)


def dictionary_links(studies: DataFrame, column: str, known: DataFrame, sep: str = ";") -> tuple[DataFrame, DataFrame]:
    """(new dictionary names, study -> upper-case name links) of a list column, without case."""
    items = studies.select("study_id", F.explode(split_list(column, sep)).alias("name")).withColumn("name", T.strip("name")).where("name <> ''")
    keyed = items.withColumn("key", F.upper("name"))
    fresh = keyed.groupBy("key").agg(F.min("name").alias("name")).join(known.select(F.upper("name").alias("key")), "key", "left_anti")
    return fresh, keyed.select("study_id", "key").distinct()


def external_links(studies: DataFrame, study: str = "study_id", publications: str = "pubmed") -> DataFrame:
    """Series links of accession-like studies and ``id:title`` publication links."""
    series = studies.where(F.startswith(study, F.lit("GSE"))).select(
        study, F.lit("GEO").alias("kind"), F.col(study).alias("target"), F.lit(None).cast("string").alias("title")
    )
    papers = studies.select(study, F.explode(split_list(publications, ";")).alias("p")).where(T.strip("p") != "")
    return series.unionByName(papers.select(
        study, F.lit("PUBMED").alias("kind"), T.strip(nth("p", 1, ":")).alias("target"), T.strip(nth("p", 2, ":")).alias("title")
    ))


def one_study_report(rows: DataFrame, record: str, study: str) -> DataFrame:
    """Records that name more than one study."""
    return rows.groupBy(record).agg(F.count_distinct(study).alias("n_studies")).where("n_studies <> 1")


def header_metadata(rows: DataFrame, study: str = "study_id", title: str = "title") -> tuple[DataFrame, DataFrame]:
    """Metadata rows with study id and title, and the rejects."""
    ok = T.blank_to_null(study).isNotNull() & T.blank_to_null(title).isNotNull()
    ok = F.coalesce(ok, F.lit(False))
    return rows.where(ok), rows.where(~ok)


def sample_categories(
    cells: DataFrame, mapping: DataFrame, record: str, subject: Column | None = None, study_level: DataFrame | None = None, studies: DataFrame | None = None, study: str = "study_id",
) -> DataFrame:
    """Sample categories (upper-case category, value) per record, with subject or study-level values.

    ``study_level`` has a value for each study and category; ``studies`` names the study of each record.
    The mapping and the study values are broadcast: shuffled by column or by study, the records of one would be one task's work.
    """
    rows = cells.join(F.broadcast(mapping.select("column_number", "category")), "column_number").where(T.strip("value") != "").select(
        record, F.upper("category").alias("category"), T.strip("value").alias("category_value")
    )
    if study_level is not None:
        held = study_level.select(study, F.upper("category").alias("category"), "category_value").distinct()
        rows = rows.unionByName(studies.select(record, study).distinct().join(F.broadcast(held), study).select(record, "category", "category_value"))
    return rows if subject is None else rows.withColumn("subject_id", subject)

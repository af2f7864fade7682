"""Probe, gene and SNP annotation of assay platforms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studyflow.functions import text as T
from studyflow.functions.paths import nth, split_list
from studyflow.operators.numbering import surrogate_ids

# Default organism, separators of embedded gene tables, control
# probe prefix and the header patterns that name annotation columns.
DEFAULT_ORGANISM = "Homo sapiens"
GENE_SEP, FIELD_SEP = "///", "//"
CONTROL_PREFIX = "AFFX"
NO_VALUE = "---"
COMMENT_MARKS = ["#", "!", "^"]
PLATFORM_LAYOUTS = {
    "GPL2004": {"probe": 1, "rs_id": 2, "chrom": 3, "position": 6, "genes": 13},
    "GPL2005": {"probe": 1, "rs_id": 2, "chrom": 3, "position": 6, "genes": 13},
    "GPL3718": {"probe": 1, "rs_id": 3, "chrom": 4, "position": 7, "genes": 14},
    "GPL3720": {"probe": 1, "rs_id": 3, "chrom": 4, "position": 7, "genes": 14},
}
PLATFORM_COLUMNS = 15
PLATFORM_GENE_FIELDS = ["accession", "relation", "distance", "transcript", "symbol", "gene_id", "title"]
HEADER_PATTERNS = {"gene_id": r"(?i)entrez", "gene_symbol": r"(?i)symbol", "organism": r"(?i)species"}
ASSAY_LANDING = {
    "proteomics": ["peptide", "uniprot_id", "organism"],
    "metabolomics": ["biochemical_name", "hmdb_id", "organism"],
    "mirna": ["id_ref", "mirna_id", "organism"],
    "rbm": ["antigen_name", "uniprot_id", "organism"],
    "rnaseq": ["transcript_id", "gene_symbol", "organism"],
}
# end of fixed values


def upsert_probes(probes: DataFrame, landing: DataFrame) -> DataFrame:
    """Refresh the organism of known probes and give new ones the next ids (``probeset_id, platform, probeset, organism``)."""
    key = ["platform", "probeset"]
    incoming = landing.groupBy(*key).agg(F.max("organism").alias("__org"))
    known = probes.join(incoming, key, "left").withColumn("organism", F.coalesce("__org", "organism")).drop("__org")
    fresh = incoming.join(probes.select(*key), key, "left_anti").withColumn(
        "organism", F.coalesce("__org", F.lit(DEFAULT_ORGANISM))
    )
    top = probes.agg(F.coalesce(F.max("probeset_id"), F.lit(0)).alias("m")).select("m").scalar()
    columns = ["probeset_id", *key, "organism"]
    return known.select(*columns).unionByName(surrogate_ids(fresh, key, "probeset_id", top).select(*columns))


def annotate(landing: DataFrame, probes: DataFrame) -> DataFrame:
    """Landing rows with their probe id, organism defaulted; replaces the platform's old annotation."""
    filled = landing.withColumn("organism", F.coalesce("organism", F.lit(DEFAULT_ORGANISM)))
    return filled.join(probes, ["platform", "probeset", "organism"]).select(
        "platform", "probeset", "gene_symbol", "gene_id", "probeset_id", "organism"
    ).distinct()


def fill_genes(annotation: DataFrame, markers: DataFrame) -> DataFrame:
    """Gene id from (symbol, organism), then symbol from (id, organism); smallest on a tie."""
    org = F.upper("organism")
    by_symbol = markers.groupBy(F.col("symbol").alias("gene_symbol"), org.alias("__org")).agg(F.min("gene_id").alias("__id"))
    by_id = markers.groupBy("gene_id", org.alias("__org")).agg(F.min("symbol").alias("__symbol"))
    keyed = annotation.withColumn("__org", org)
    with_id = keyed.join(by_symbol, ["gene_symbol", "__org"], "left").withColumn("gene_id", F.coalesce("gene_id", "__id")).drop("__id")
    full = with_id.join(by_id, ["gene_id", "__org"], "left").withColumn("gene_symbol", F.coalesce("gene_symbol", "__symbol"))
    return full.select(*annotation.columns)


def nested_genes(rows: DataFrame, table: str, ids: list[str], names: list[str]) -> DataFrame:
    """Embedded gene table: ``///`` separates genes, ``//`` their fields."""
    genes = rows.select(*ids, F.posexplode(split_list(table, GENE_SEP)).alias("pos", "__gene"))
    fields = [T.blank_to_null(nth("__gene", i + 1, FIELD_SEP)).alias(n) for i, n in enumerate(names)]
    return genes.select(*ids, (F.col("pos") + 1).alias("pos"), *fields)


def by_number(lines: DataFrame, places: DataFrame, fields: list[str], platform: str = "platform", line: str = "line", sep: str = "\t") -> DataFrame:
    """Fields of annotation lines, each platform's columns picked by its own numbers (``platform, field, column_number``, from 1 on).

    Comment lines are skipped; a field that a platform does not place, or whose column a line does not have, is null. Lines of a platform
    without places are left out.
    """
    numbers = places.groupBy(F.col(platform).alias("__platform")).agg(*[F.min(F.when(F.col("field") == f, F.col("column_number").try_cast("int"))).alias(f"__{f}") for f in fields])
    data = lines.where(~F.substring(line, 1, 1).isin(*COMMENT_MARKS) & (F.trim(line) != "")).withColumn("__cells", split_list(line, sep))
    picked = data.join(numbers, F.col(platform) == F.col("__platform"))
    return picked.select(platform, *[T.blank_to_null(F.get("__cells", F.col(f"__{f}") - 1)).alias(f) for f in fields])


def zip_by_position(ids: DataFrame, symbols: DataFrame, key: list[str]) -> DataFrame:
    """Pair ids and symbols of the same list position, keeping the unpaired."""
    return ids.join(symbols, [*key, "pos"], "full")


def header_columns(header: list[str], patterns: dict[str, str] | None = None) -> dict[str, str]:
    """Which file columns hold gene id, symbol and organism, from the header text."""
    import re

    patterns = patterns or HEADER_PATTERNS
    return {name: next((h for h in header if re.search(p, h)), None) for name, p in patterns.items()}


def by_header(rows: DataFrame, probe: str, columns: dict[str, str], platform: str, organism: str = DEFAULT_ORGANISM) -> DataFrame:
    """Annotation rows picked by header, only with all-digit gene ids."""
    def pick(name: str) -> Column:
        return F.col(columns[name]) if columns.get(name) else F.lit(None).cast("string")

    return rows.select(
        F.lit(platform).alias("platform"), F.col(probe).alias("probeset"), pick("gene_symbol").alias("gene_symbol"),
        pick("gene_id").alias("gene_id"), F.coalesce(T.blank_to_null(pick("organism")), F.lit(organism)).alias("organism"),
    ).where(F.rlike("gene_id", F.lit("^[0-9]+$")))


def is_control(probe: Column, gene: Column | None = None) -> Column:
    control = F.startswith(probe, F.lit(CONTROL_PREFIX))
    return control if gene is None else control | T.has(gene, NO_VALUE)


def gene_assignments(rows: DataFrame, assignment: str, ids: list[str]) -> tuple[DataFrame, DataFrame]:
    """``a // symbol // title // x // id`` lists: distinct (symbol, title, gene id) per probe, and rejects."""
    genes = nested_genes(rows, assignment, ids, ["accession", "symbol", "title", "location", "gene_id"])
    result = genes.where("symbol is not null").select(*ids, "symbol", "title", "gene_id").distinct()
    return result, rows.join(result.select(*ids).distinct(), ids, "left_anti")


def snp_annotation(rows: DataFrame, probe: str, rs: str, chrom: str, pos: str, genes: str) -> tuple[DataFrame, DataFrame]:
    """(SNP rows, SNP -> gene rows) of an array annotation, without controls and unplaced probes."""
    placed = rows.where(~is_control(F.col(probe)) & (F.col(chrom) != NO_VALUE)).withColumn("__pos", T.to_number(pos).cast("long"))
    snps = placed.select(F.col(probe).alias("snp_id"), F.col(rs).alias("rs_id"), F.col(chrom).alias("chrom"), F.col("__pos").alias("position"))
    links = nested_genes(placed, genes, [probe], ["accession", "relation", "distance", "cytoband", "symbol"]).where("symbol is not null")
    return snps, links.select(F.col(probe).alias("snp_id"), "symbol").distinct()


def platform_probes(
    lines: DataFrame, layout: dict[str, int], line: str = "line", min_columns: int = PLATFORM_COLUMNS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Platform file lines by a column layout: (probe -> rs, probe -> gene, map rows).

    Controls and unplaced probes give neither probe nor map rows; probes
    without an rs id only give map rows.
    """
    body = lines.where(~F.rlike(line, F.lit("^([#!^]|ID)")) & (F.size(split_list(line, "\t")) >= min_columns))
    picked = body.select(*[T.strip(nth(line, i, "\t")).alias(n) for n, i in layout.items()])
    placed = picked.where((F.col("chrom") != "") & (F.col("position") != "") & ~F.contains("probe", F.lit(CONTROL_PREFIX)))
    probes = placed.where(~T.has("rs_id", NO_VALUE)).select("probe", "rs_id", "chrom", "position")
    genes = nested_genes(picked, "genes", ["probe"], PLATFORM_GENE_FIELDS).where(
        F.col("gene_id").isNotNull() & ~T.has("gene_id", NO_VALUE)
    ).select("probe", "gene_id", "symbol").distinct()
    mapped = placed.select("chrom", "probe", F.lit(0).alias("distance"), "position")
    return probes, genes, mapped


def short_platform_lines(lines: DataFrame, line: str = "line", min_columns: int = PLATFORM_COLUMNS) -> DataFrame:
    """Platform lines with too few columns: rejects of ``platform_probes``."""
    return lines.where(~F.rlike(line, F.lit("^([#!^]|ID)")) & (F.size(split_list(line, "\t")) < min_columns))


def platform_catalogue(platforms: DataFrame, incoming: DataFrame) -> DataFrame:
    """Insert-or-update of platforms (title, marker type, organism)."""
    from studyflow.operators.merge import upsert

    return upsert(platforms, incoming, ["platform"], ["title", "marker_type", "organism"])


def assay_landing(rows: DataFrame, assay: str, platform: str) -> tuple[DataFrame, DataFrame]:
    """Annotation landing rows of one assay kind and the rejects without an identifier."""
    identifier, marker, organism = ASSAY_LANDING[assay]
    named = rows.select(
        F.lit(platform).alias("platform"), T.blank_to_null(identifier).alias(identifier), T.blank_to_null(marker).alias(marker),
        F.coalesce(T.blank_to_null(organism), F.lit(DEFAULT_ORGANISM)).alias("organism"),
    )
    return named.where(F.col(identifier).isNotNull()), named.where(F.col(identifier).isNull())

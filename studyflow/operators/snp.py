"""Genotype calls, copy numbers and their dense vectors.

A dense vector is stored in consecutive parts of ``part_size`` positions:
joined in part order they are the whole vector, and no task holds more than
one part whatever the number of patients or SNPs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from studyflow.functions import genome as G
from studyflow.functions import text as T
from studyflow.functions.paths import split_list
from studyflow.operators.numbering import number_rows, surrogate_ids
from studyflow.operators.reshape import unpivot_matrix
from studyflow.sources.files import file_name
from studyflow.sources.headed import header_rows, placed_lines, section, text_after

PART_SIZE = 1000


def ordered_definition(
    items: DataFrame, order: list[str], keys: list[str] | None = None, slice_by: Column | None = None, out: str = "position"
) -> DataFrame:
    """Position (vector index) of every subject or probe in definition order."""
    return number_rows(items, order, keys, slice_by, out)


def vector_parts(
    calls: DataFrame, keys: list[str], position: str, item: Column, sep: str = " ", part_size: int = PART_SIZE
) -> DataFrame:
    """Ordered concatenation of the items per key and part."""
    part = (F.floor((F.col(position) - 1) / part_size) + 1).cast("long")
    grouped = calls.groupBy(*keys, part.alias("part")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), item.alias("v")))).alias("__l")
    )
    return grouped.select(*keys, "part", F.size("__l").cast("long").alias("n_calls"), F.array_join(F.col("__l.v"), sep).alias("vector"))


def by_probe(calls: DataFrame, part_size: int = PART_SIZE) -> DataFrame:
    """Genotype transpose: ``A1A2`` of every patient, per SNP (``snp_id, patient_pos, allele_1, allele_2``)."""
    return vector_parts(calls, ["snp_id"], "patient_pos", F.concat("allele_1", "allele_2"), " ", part_size)


def by_patient(calls: DataFrame, copy_numbers: DataFrame | None = None, part_size: int = PART_SIZE) -> DataFrame:
    """Per patient and chromosome; with copy numbers each item is ``CN<tab>A1<tab>A2``."""
    if copy_numbers is None:
        return vector_parts(calls, ["patient_id", "chrom"], "snp_pos", F.concat_ws(" ", "allele_1", "allele_2"), " ", part_size)
    merged = calls.join(copy_numbers.select("patient_id", "snp_id", "copy_number"), ["patient_id", "snp_id"], "left")
    cell = F.concat_ws("\t", F.coalesce(F.col("copy_number").cast("string"), F.lit("")), F.col("allele_1"), F.col("allele_2"))
    return vector_parts(merged, ["patient_id", "chrom"], "snp_pos", cell, "\n", part_size)


def all_chromosomes(parts: DataFrame) -> DataFrame:
    """The whole-genome vector: the parts of chromosomes 1 to 24 in order, renumbered."""
    number = F.col("chrom").try_cast("int")
    genome = parts.where(number.between(1, 24))
    order = W.partitionBy("patient_id").orderBy(number, "part")
    return genome.withColumn("__p", F.row_number().over(order).cast("long")).select(
        "patient_id", F.lit("ALL").alias("chrom"), F.col("__p").alias("part"), "n_calls", "vector"
    )


def matrix_calls(matrix: DataFrame, probe: str, calls: dict[str, str], samples: list[str] | None = None, suffix: str = ".CEL") -> DataFrame:
    """Genotype matrix to long calls through the file's call dictionary."""
    long = unpivot_matrix(matrix, [probe], samples, "sample", "code")
    pair = G.genotype(F.col("code"), calls)
    return long.select(
        F.replace("sample", F.lit(suffix), F.lit("")).alias("sample"), F.col(probe).alias("snp_id"), G.alleles(pair).alias("alleles")
    )


def headed_calls(spark: SparkSession, paths: str | list[str], dictionary: str = "#Calls:", columns: str = "probeset_id", data: str = "SNP_A-", suffix: str = ".CEL") -> DataFrame:
    """file_path, sample, snp_id, code and alleles of genotype matrices, each read by its own call dictionary and column header.

    A file's two header lines are one small row, which its data lines join, wherever the file was split. A code that the dictionary does not
    list, and a file without one, give null alleles.
    """
    lines = placed_lines(spark, paths)
    starts = lambda mark: F.startswith("line", F.lit(mark))
    heads = header_rows(lines, calls=starts(dictionary), header=starts(columns))
    entry = lambda kv: F.struct(T.strip(F.substring_index(kv, "=", 1)).alias("code"), F.replace(T.strip(F.substring_index(kv, "=", -1)), F.lit("NN"), F.lit("00")).alias("pair"))
    known = F.transform(F.filter(split_list(F.substring("calls", len(dictionary) + 1, 1 << 30), ","), lambda kv: F.contains(kv, F.lit("="))), entry)
    heads = heads.select("file_path", known.alias("known"), F.transform(split_list("header", "\t"), lambda c: F.replace(c, F.lit(suffix), F.lit(""))).alias("samples"))
    cells = lines.where(starts(data)).join(heads, "file_path", "left").withColumn("__cells", split_list("line", "\t"))
    long = cells.select("file_path", "known", "samples", F.get("__cells", F.lit(0)).alias("snp_id"), F.posexplode("__cells").alias("at", "code")).where("at > 0")
    pair = F.try_element_at(F.filter("known", lambda e: e["code"] == F.col("code")), F.lit(-1))["pair"]
    return long.select("file_path", F.get("samples", F.col("at")).alias("sample"), "snp_id", "code", G.alleles(pair).alias("alleles"))


def copy_number_sections(spark: SparkSession, paths: str | list[str], marker: str = "[Data]") -> tuple[DataFrame, DataFrame]:
    """Rows of the data sections (file_path, sample, snp_id, chrom, position, copy_number) and the check of every file.

    The check has the declared and the found number of rows, and whether the file's name begins with its sample; a file without a marker has
    no rows, one without a declared number is not complete.
    """
    lines = placed_lines(spark, paths)
    starts = lambda name: F.startswith("line", F.lit(name + "="))
    heads = header_rows(lines, sample=starts("SampleName"), declared=starts("NumberDataRows"))
    heads = heads.select("file_path", text_after("sample", "SampleName").alias("sample"), text_after("declared", "NumberDataRows").try_cast("long").alias("declared"))
    cells = split_list("line", "\t")
    cell = lambda k: T.strip(F.get(cells, F.lit(k)))
    data = section(lines, marker)
    # Places of the marker, chromosome, position and copy number in a data line.
    rows = data.select("file_path", cell(0).alias("snp_id"), cell(1).alias("chrom"), cell(2).alias("position"), cell(5).alias("copy_number"))
    files = lines.select("file_path").distinct().join(heads, "file_path", "left")
    check = section_check(rows, files, ["file_path"]).withColumn("complete", F.coalesce("complete", F.lit(False)))
    named = F.coalesce(F.startswith(file_name(F.col("file_path")), F.col("sample")), F.lit(False))
    rows = rows.join(heads.select("file_path", "sample"), "file_path", "left").select("file_path", "sample", "snp_id", "chrom", "position", "copy_number")
    return rows, check.withColumn("name_fits", named).select("file_path", "sample", "declared", "n_read", "complete", "name_fits")


REGISTRY = ["dataset_id", "dataset_name", "patient_num", "platform", "trial", "position"]


def register_datasets(registry: DataFrame, subjects: DataFrame, order: list[str]) -> DataFrame:
    """The rows to append to a registry of subject datasets: new (dataset, patient) pairs of ``subjects`` with ids and vector positions.

    ``subjects`` has ``trial, subject_id, sample, patient_num, platform``. A dataset is named by trial, subject and sample. Ids go on after the
    greatest id, positions after the greatest of the platform and trial, in ``order``: what is registered keeps both over all reloads, and late
    subjects come last.
    """
    sample = T.blank_to_null("sample")
    named = subjects.withColumn("dataset_name", F.concat_ws("_", "trial", "subject_id", sample)).dropDuplicates(["dataset_name", "patient_num"])
    fresh = named.join(registry.select("dataset_name", "patient_num"), ["dataset_name", "patient_num"], "left_anti")
    ranked = number_rows(fresh, [*order, "dataset_name", "patient_num"], ["platform", "trial"], out="__n")
    last = registry.groupBy("platform", "trial").agg(F.max("position").alias("__last"))
    placed = ranked.join(last, ["platform", "trial"], "left").withColumn("position", F.coalesce("__last", F.lit(0)) + F.col("__n"))
    top = registry.agg(F.coalesce(F.max("dataset_id"), F.lit(0)).alias("m")).select("m").scalar()
    return surrogate_ids(placed, ["dataset_name", "patient_num"], "dataset_id", top).select(*REGISTRY)


def lgen(calls: DataFrame, sample_patient: DataFrame, family: str = "0") -> DataFrame:
    """Long genotype rows: family, patient, SNP, alleles."""
    return calls.join(sample_patient, "sample").select(
        F.lit(family).alias("family"), "patient_id", "snp_id", "alleles"
    )


def fam(patients: DataFrame, family: str = "0") -> DataFrame:
    """Family rows: no parents, coded sex, unknown phenotype."""
    return patients.select(
        F.lit(family).alias("family"), "patient_id", F.lit("0").alias("father"), F.lit("0").alias("mother"),
        F.when(F.col("sex") == "Male", "1").when(F.col("sex") == "Female", "2").otherwise("0").alias("sex"),
        F.lit("-9").alias("phenotype"),
    )


def map_rows(snps: DataFrame) -> DataFrame:
    """Map rows with numeric chromosome codes."""
    return snps.select(G.chromosome_code(F.col("chrom")).alias("chrom"), "snp_id", F.lit(0).alias("distance"), "position")


def conflicting_samples(mapping: DataFrame, sample: str = "sample", patient: str = "patient_id") -> DataFrame:
    """Samples mapped to more than one patient."""
    return mapping.groupBy(sample).agg(F.count_distinct(patient).alias("n_patients")).where("n_patients > 1")


def section_check(rows: DataFrame, declared: DataFrame, keys: list[str]) -> DataFrame:
    """Data rows read against the declared row count of each file."""
    read = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_read"))
    return declared.join(read, keys, "left").withColumn("n_read", F.coalesce("n_read", F.lit(0))).withColumn(
        "complete", F.col("n_read") == F.col("declared")
    )


def write_by_chromosome(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("sep", "\t").partitionBy("chrom").csv(path)


def calls_by_sample(calls: DataFrame, samples: DataFrame) -> DataFrame:
    """Calls with the patient of their sample, kept where no patient is known."""
    return calls.join(samples.select("sample", "patient_id"), "sample", "left").select("sample", "patient_id", "snp_id", "call")


def new_snps(annotation: DataFrame, existing: DataFrame) -> DataFrame:
    """SNP rows that are not in the catalogue."""
    return annotation.select("snp_id", "chrom", "position").distinct().join(existing.select("snp_id"), "snp_id", "left_anti")


def gene_links(links: DataFrame, snps: DataFrame, genes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SNP -> gene rows with gene ids by symbol, and the links without a parent SNP."""
    known = links.join(snps.select("snp_id"), "snp_id", "left_semi")
    rejects = links.join(snps.select("snp_id"), "snp_id", "left_anti")
    ids = genes.groupBy(F.upper("symbol").alias("__s")).agg(F.min("gene_id").alias("gene_id"))
    return known.join(ids, F.upper("symbol") == F.col("__s"), "left").select("snp_id", "symbol", "gene_id"), rejects

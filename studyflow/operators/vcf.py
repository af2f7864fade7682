"""Variant files: multi-id rows, INFO attributes and gene pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studyflow.functions.genome import info_attribute
from studyflow.functions.paths import nth, split_list
from studyflow.operators.numbering import surrogate_ids
from studyflow.session import staged

# Columns of a variant line and the separators of gene pairs.
VCF_COLUMNS = ["chrom", "pos", "ids", "ref", "alt", "qual", "filter", "info"]
PAIR_SEP, SYMBOL_SEP = "|", ":"
# end of fixed values


def variants(lines: DataFrame, info: list[str], line: str = "line") -> DataFrame:
    """One row per variant id with class, gene info and the selected INFO attributes."""
    body = lines.where(~F.startswith(line, F.lit("#")))
    cells = body.select(*[nth(line, i + 1, "\t").alias(c) for i, c in enumerate(VCF_COLUMNS)])
    return cells.select(
        "chrom", F.col("pos").try_cast("long").alias("pos"), F.explode(split_list("ids", ";")).alias("rs_id"), "ref", "alt",
        info_attribute(F.col("info"), "VC").alias("variant_class"),
        info_attribute(F.col("info"), "GENEINFO").alias("gene_info"),
        *[info_attribute(F.col("info"), k).alias(k.lower()) for k in info],
    )


def genes(rows: DataFrame, place: tuple[str, ...] = ("chrom", "pos", "rs_id")) -> DataFrame:
    """(variant, gene symbol, gene id) pairs; a variant is named by ``place``."""
    pairs = rows.where("gene_info <> ''").select(*place, F.explode(split_list("gene_info", PAIR_SEP)).alias("__p"))
    return pairs.select(
        *place, nth("__p", 1, SYMBOL_SEP).alias("gene_symbol"), nth("__p", 2, SYMBOL_SEP).alias("gene_id")
    ).distinct()


def catalogue(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Variants to add to the catalogue: one row per id that is not there."""
    fresh = rows.groupBy("rs_id").agg(F.min_by(F.struct("chrom", "pos", "ref", "alt", "variant_class"), F.struct("chrom", "pos", "ref", "alt")).alias("v"))
    return fresh.select("rs_id", "v.*").join(known.select("rs_id"), "rs_id", "left_anti")


def load_catalogue(rows: DataFrame, info: DataFrame, gene_map: DataFrame, keywords: DataFrame, terms: DataFrame) -> dict[str, DataFrame]:
    """What a variant file adds to the catalogue, in the order in which the tables need each other's ids; nothing that is there comes again.

    ``info`` (snp_info_id, name, chrom, pos), ``gene_map`` (snp_info_id, name, gene_id), ``keywords`` (keyword_id, keyword, bio_data_id, unique_id, category)
    and ``terms`` (term, keyword_id, rank, length) are the tables so far. Genes attach to every place of an id, known or new; every variant without
    a keyword gets one, every keyword without a first-rank term its upper-case term. ``rows`` and ``info`` are read several times: give written ones.
    """
    def numbered(fresh: DataFrame, table: DataFrame, key: list[str], out: str) -> DataFrame:
        top = table.agg(F.coalesce(F.max(out), F.lit(0)).alias("m")).select("m").scalar()
        return staged(surrogate_ids(fresh, key, out, top).select(*table.columns), out)

    place = ["name", "chrom", "pos"]
    found = rows.select(F.col("rs_id").alias("name"), "chrom", "pos").where("name <> '' and pos is not null").distinct()
    fresh = numbered(found.join(info.select(*place), place, "left_anti"), info, place, "snp_info_id")
    variants_ = info.unionByName(fresh)
    pairs = genes(rows, ("rs_id",)).where("gene_id <> ''").select(F.col("rs_id").alias("name"), F.col("gene_id")).distinct()
    mapped = variants_.select("snp_info_id", "name").join(pairs, "name").select(*gene_map.columns)
    words = variants_.select(F.col("name").alias("keyword"), F.col("snp_info_id").alias("bio_data_id"), F.concat(F.lit("SNP:"), "name").alias("unique_id"), F.lit("SNP").alias("category"))
    key = ["keyword", "bio_data_id", "unique_id", "category"]
    new_words = numbered(words.join(keywords.select(*key), key, "left_anti"), keywords, key, "keyword_id")
    ranked = terms.where("rank = 1").select("keyword_id")
    new_terms = keywords.unionByName(new_words).join(ranked, "keyword_id", "left_anti").select(F.upper("keyword").alias("term"), "keyword_id", F.lit(1).alias("rank"), F.length("keyword").alias("length"))
    return {"info": fresh, "gene_map": mapped.join(gene_map, gene_map.columns, "left_anti"), "keywords": new_words, "terms": new_terms}

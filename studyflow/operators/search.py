"""Search index: keywords, terms, taxonomy and unique ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studyflow.operators.numbering import surrogate_ids


def unique_ids(rows: DataFrame, key: Column, kind: str, existing: DataFrame) -> DataFrame:
    """``KIND:key`` registry rows that are not there yet."""
    made = rows.select(F.concat(F.lit(kind + ":"), key.cast("string")).alias("unique_id"), F.lit(kind).alias("kind")).distinct()
    return made.join(existing.select("unique_id"), "unique_id", "left_anti")


def ext_codes(synonyms: DataFrame, owners: DataFrame, on: str, kind: str, existing: DataFrame) -> DataFrame:
    """Synonym codes of known owners, minus those already stored."""
    rows = synonyms.join(owners.select(on, "owner_id"), on).select("owner_id", "code", F.lit("Alias").alias("code_source"), F.lit("SYNONYM").alias("code_type"), F.lit(kind).alias("kind")).distinct()
    return rows.join(existing.select("owner_id", "code"), ["owner_id", "code"], "left_anti")


def add_keywords(index: DataFrame, names: DataFrame, category: str) -> DataFrame:
    """New keywords (``keyword_id, keyword, category``) appended with the next ids; case is ignored."""
    fresh = names.groupBy(F.upper("name").alias("__k")).agg(F.min("name").alias("keyword"))
    fresh = fresh.join(index.where(F.upper("category") == category.upper()).select(F.upper("keyword").alias("__k")), "__k", "left_anti")
    top = index.agg(F.coalesce(F.max("keyword_id"), F.lit(0)).alias("m")).select("m").scalar()
    made = surrogate_ids(fresh.drop("__k"), ["keyword"], "keyword_id", top).withColumn("category", F.lit(category))
    return index.unionByName(made.select(*index.columns))


def keyword_terms(keywords: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Rank 1 terms are the keywords, rank 2 their synonyms, both upper case with length."""
    first = keywords.select("keyword_id", F.upper("keyword").alias("term"), F.lit(1).alias("rank"))
    second = synonyms.select("keyword_id", F.upper("synonym").alias("term"), F.lit(2).alias("rank"))
    best = first.unionByName(second).groupBy("keyword_id", "term").agg(F.min("rank").alias("rank"))
    return best.withColumn("term_length", F.length("term"))


def new_terms(terms: DataFrame, existing: DataFrame) -> DataFrame:
    return terms.join(existing.select("keyword_id", "term"), ["keyword_id", "term"], "left_anti")


def add_taxonomy_terms(taxonomy: DataFrame, requested: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A batch of (term, parent) rows: the grown taxonomy and the child -> parent relations."""
    known = taxonomy.select(F.upper("term_name").alias("__k"))
    fresh = requested.select("term").distinct().withColumn("__k", F.upper("term")).join(known, "__k", "left_anti")
    top = taxonomy.agg(F.coalesce(F.max("term_id"), F.lit(0)).alias("m")).select("m").scalar()
    made = surrogate_ids(fresh.select(F.col("term").alias("term_name")), ["term_name"], "term_id", top)
    grown = taxonomy.select("term_id", "term_name").unionByName(made.select("term_id", "term_name"))
    side = grown.withColumn("__k", F.upper("term_name"))
    links = requested.withColumns({"__c": F.upper("term"), "__p": F.upper("parent")})
    relations = links.join(side.select(F.col("__k").alias("__c"), F.col("term_id").alias("child_id")), "__c").join(
        side.select(F.col("__k").alias("__p"), F.col("term_id").alias("parent_id")), "__p"
    ).select("child_id", "parent_id").distinct()
    return grown, relations


def content_links(pathways: DataFrame, repository_url: str, existing: DataFrame) -> DataFrame:
    """Repository links of pathways that have none yet."""
    made = pathways.select("pathway_id", F.concat(F.lit(repository_url), "external_id").alias("location")).distinct()
    return made.join(existing.select("location"), "location", "left_anti")

"""Operations on the materialised-path concept tree.

Prefix theta joins (``child LIKE parent%``) are written as an explode of the
ancestor paths followed by an equi join or aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studyflow.functions import paths as P
from studyflow.operators.numbering import surrogate_ids

# Visual attributes of folders, root containers and leaves.
FOLDER, CONTAINER, LEAF, SAMPLE_LEAF = "FA", "CA", "LA", "LAH"
PUBLIC_TOKEN = "EXP:PUBLIC"
SECURITY_NODE = "SECURITY"
STUB_TITLE = "Metadata not available"
# end of fixed values


def node_rows(paths: DataFrame, path: str = "path", root_level: int = 0, attributes: str = FOLDER) -> DataFrame:
    """Level, name, parent and attributes of a set of paths."""
    return paths.withColumns({
        "level": P.level(path, root_level), "name": P.leaf_name(path),
        "parent_path": P.parent(path), "attributes": F.lit(attributes),
    })


def fill_ancestors(nodes: DataFrame, path: str = "path", sep: str = P.SEP) -> DataFrame:
    """Every path with all its ancestors, once."""
    return nodes.select(F.explode(P.ancestors(path, sep)).alias(path)).distinct()


def missing_ancestors(nodes: DataFrame, path: str = "path") -> DataFrame:
    """Ancestors that have no row yet."""
    above = nodes.select(F.explode(P.ancestors(path, with_self=False)).alias(path)).distinct()
    return above.join(nodes.select(path), path, "left_anti")


def add_nodes(tree: DataFrame, new: DataFrame, path: str = "path", root_level: int = 0) -> DataFrame:
    """Add paths that are not there yet; a path of one part becomes a container root."""
    fresh = new.select(path).distinct().join(tree.select(path), path, "left_anti")
    rows = node_rows(fresh, path, root_level).withColumn(
        "attributes", F.when(P.depth(path) == 1, CONTAINER).otherwise(FOLDER)
    )
    return tree.unionByName(rows.select(*tree.columns))


def upsert_concepts(concepts: DataFrame, leaves: DataFrame) -> DataFrame:
    """Rename known concepts and give new ones the next ids (``concept_cd, concept_path, name``)."""
    incoming = leaves.select("concept_path", F.col("name").alias("__new")).distinct()
    known = concepts.join(incoming, "concept_path", "left").withColumn("name", F.coalesce("__new", "name")).drop("__new")
    fresh = incoming.join(concepts.select("concept_path"), "concept_path", "left_anti").withColumnRenamed("__new", "name")
    top = concepts.agg(F.coalesce(F.max("concept_cd"), F.lit(0)).alias("m")).select("m").scalar()
    columns = ["concept_cd", "concept_path", "name"]
    return known.select(*columns).unionByName(surrogate_ids(fresh, ["concept_path"], "concept_cd", top).select(*columns))


def counts(facts: DataFrame, path: str = "path", member: str = "patient_num", sep: str = P.SEP) -> DataFrame:
    """Distinct members under every node.

    Pairs are made distinct at the leaf first, then (ancestor, member) pairs
    are combined map-side, so a node near the root is never one task's work.
    """
    pairs = facts.select(path, member).distinct()
    rolled = pairs.select(F.explode(P.ancestors(path, sep)).alias(path), member).distinct()
    return rolled.groupBy(path).agg(F.count(member).alias("patient_count")).withColumn("parent_path", P.parent(path, sep))


def without_sample_subjects(patients: DataFrame, key: str = "subject_key") -> DataFrame:
    """Leave out subjects that only stand for a sample."""
    return patients.where(~F.contains(F.col(key), F.lit(":S:")))


def scoped_counts(tree: DataFrame, facts: DataFrame, patients: DataFrame, scope: str, path: str = "path", member: str = "patient_num") -> DataFrame:
    """Distinct known patients under every visible node at or below ``scope``.

    Facts count where their own node is a visible leaf; subjects that only stand for a sample, and members that are no patients, do not.
    """
    shown = tree.where(P.under(path, scope) & (F.substring("attributes", 2, 1) != "H")).select(path, "attributes")
    leaves = shown.where(F.startswith("attributes", F.lit("L"))).select(path)
    known = without_sample_subjects(patients) if "subject_key" in patients.columns else patients
    pairs = facts.select(path, member).distinct().join(leaves, path, "left_semi").join(known.select(member).distinct(), member, "left_semi")
    return counts(pairs, path, member).join(shown.select(path), path, "left_semi")


def hide_uncounted(tree: DataFrame, counted: DataFrame, path: str = "path", scope: str | None = None) -> DataFrame:
    """Mark nodes without patients as hidden, but never the security node; with ``scope`` only nodes at or below that path."""
    positive = counted.where("patient_count > 0").select(path, F.lit(True).alias("__ok"))
    hide = F.col("__ok").isNull() & (F.col("name") != SECURITY_NODE)
    if scope is not None:
        hide = hide & P.under(path, scope)
    return tree.join(positive, path, "left").withColumn(
        "attributes", F.when(hide, P.overlay_char("attributes", 2, "H")).otherwise(F.col("attributes"))
    ).select(*tree.columns)


def hidden(tree: DataFrame) -> DataFrame:
    return tree.where(F.substring("attributes", 2, 1) == "H")


def delete(tree: DataFrame, doomed: DataFrame, path: str = "path", subtree: bool = False) -> DataFrame:
    """Remove single nodes, or whole subtrees."""
    if not subtree:
        return tree.join(doomed.select(path).distinct(), path, "left_anti").select(*tree.columns)
    above = tree.select(path, F.explode(P.ancestors(path)).alias("__up"))
    below = above.join(doomed.select(F.col(path).alias("__up")).distinct(), "__up", "left_semi").select(path).distinct()
    return tree.join(below, path, "left_anti").select(*tree.columns)


def unused_leaves(tree: DataFrame, top_node: str, new_leaves: DataFrame, sample_paths: DataFrame, path: str = "path") -> DataFrame:
    """Leaves of a study that neither the reload nor a sample uses."""
    old = tree.where(F.startswith("attributes", F.lit("L")) & P.under(path, top_node)).select(path)
    used = new_leaves.select(path).union(sample_paths.select(path)).distinct()
    return old.join(used, path, "left_anti")


def set_leaf_flags(tree: DataFrame, top_node: str, highlight: bool = False, path: str = "path") -> DataFrame:
    """Leaf or folder by the number of nodes at or below; folders hold text."""
    below = tree.select(F.explode(P.ancestors(path)).alias(path)).groupBy(path).agg(F.count(F.lit(1)).alias("__n"))
    scope = P.under(path, top_node)
    attributes = F.col("attributes")
    third = F.when((F.col(path) == top_node) & F.lit(highlight), "J").otherwise(F.substring(attributes, 3, 1))
    flags = F.when(F.col("__n") == 1, F.concat(F.lit("L"), F.substring(attributes, 2, 2))).otherwise(
        F.concat(F.lit("F"), F.substring(attributes, 2, 1), third)
    )
    return tree.join(below, path, "left").withColumns({
        "attributes": F.when(scope, flags).otherwise(attributes),
        "data_type": F.when(scope & (F.col("__n") > 1), "T").otherwise(F.col("data_type")),
    }).select(*tree.columns)


def clear_source_above(tree: DataFrame, study: str, top_node: str, path: str = "path") -> DataFrame:
    above = (F.col("source") == study) & (F.length(path) < len(top_node))
    return tree.withColumn("source", F.when(~F.coalesce(above, F.lit(False)), F.col("source")))


def move(tree: DataFrame, old: str, new: str, path: str = "path") -> DataFrame:
    """Move a subtree: rewrite the prefix and recompute the level."""
    inside = P.under(path, old)
    changes = {path: F.when(inside, F.concat(F.lit(new), F.substring(F.col(path), len(old) + 1, 1 << 30))).otherwise(F.col(path))}
    if "level" in tree.columns:
        shift = new.count(P.SEP) - old.count(P.SEP)
        changes["level"] = F.when(inside, F.col("level") + shift).otherwise(F.col("level"))
    return tree.withColumns(changes)


def rename(tree: DataFrame, old: str, new: str, scope: Column, columns: list[str], name: str | None = "name") -> DataFrame:
    """Rename a path part in the given path columns, and the node's own name."""
    def swapped(c: str) -> Column:
        return F.when(scope, F.replace(F.col(c), F.lit(f"\\{old}\\"), F.lit(f"\\{new}\\"))).otherwise(F.col(c))

    changes = {c: swapped(c) for c in columns}
    if name:
        changes[name] = F.when(scope & (F.col(name) == old), F.lit(new)).otherwise(F.col(name))
    return tree.withColumns(changes)


def set_visible(tree: DataFrame, prefix: str, visible: bool, path: str = "path") -> DataFrame:
    flag = P.overlay_char("attributes", 2, "A" if visible else "H")
    return tree.withColumn("attributes", F.when(P.under(path, prefix), flag).otherwise(F.col("attributes")))


def show_again(tree: DataFrame, prefix: str, facts: DataFrame, patients: DataFrame, path: str = "path", member: str = "patient_num") -> tuple[DataFrame, DataFrame]:
    """Unhide a subtree and count it anew: (tree, counts under the prefix)."""
    shown = set_visible(tree, prefix, True, path)
    return shown, scoped_counts(shown, facts, patients, prefix, path, member)


def security_rows(patients: DataFrame, study: Column, secured: Column) -> DataFrame:
    """One token row per patient of a study."""
    return patients.select(
        "patient_num", F.lit(SECURITY_NODE).alias("concept_cd"), study.alias("study_id"),
        F.when(secured, F.concat(F.lit("EXP:"), study)).otherwise(PUBLIC_TOKEN).alias("token"),
    )


def secured(tree: DataFrame, tokens: DataFrame, source: str = "source") -> DataFrame:
    """The tree with its access token, public where no study claims the node."""
    side = tokens.select(F.col("study_id").alias(source), "token").distinct()
    return tree.join(side, source, "left").withColumn("token", F.coalesce("token", F.lit(PUBLIC_TOKEN))).select(*tree.columns, "token")


def secure_objects(tree: DataFrame, registered: DataFrame, source: str = "source", path: str = "path") -> DataFrame:
    """Studies to register, named by their top nodes: ``<second part> - <name>``."""
    top = tree.where(F.col(source).isNotNull()).groupBy(source).agg(F.min("level").alias("level"))
    named = tree.join(top, [source, "level"]).select(
        source, F.concat_ws(" - ", P.nth(path, 2), F.col("name")).alias("display_name"),
        F.concat(F.lit("EXP:"), F.col(source)).alias("object_id"),
    )
    return named.join(registered.select("object_id"), "object_id", "left_anti")


def register_security(tree: DataFrame, studies: DataFrame, registered: DataFrame, experiments: DataFrame, source: str = "source") -> tuple[DataFrame, DataFrame]:
    """(secure objects, experiments) after studies are secured or opened.

    ``studies`` (source, secured) holds the studies of this run, ``registered`` (object_id, display_name, experiment_id) and ``experiments``
    (experiment_id, accession, title) the tables so far. A study that becomes secured without an experiment gets a stub one; a study that is opened loses
    its object and keeps its experiment; objects of other studies stay.
    """
    object_id = F.concat(F.lit("EXP:"), F.col(source))
    secured_ = studies.where("secured").select(source).distinct()
    opened = studies.where("not secured").select(object_id.alias("object_id"))
    wanted = secure_objects(tree.join(secured_, source, "left_semi"), registered, source)
    missing = wanted.select(F.col(source).alias("accession")).distinct().join(experiments.select("accession"), "accession", "left_anti")
    top = experiments.agg(F.coalesce(F.max("experiment_id"), F.lit(0)).alias("m")).select("m").scalar()
    stubs = surrogate_ids(missing, ["accession"], "experiment_id", top).withColumn("title", F.lit(STUB_TITLE))
    after = experiments.select("experiment_id", "accession", "title").unionByName(stubs.select("experiment_id", "accession", "title"))
    new = wanted.join(after.select(F.col("accession").alias(source), "experiment_id"), source).select("object_id", "display_name", "experiment_id")
    kept = registered.select("object_id", "display_name", "experiment_id").join(opened, "object_id", "left_anti")
    return kept.unionByName(new), after


def counts_by_level(subjects: DataFrame, base: str, levels: list[str], member: str) -> DataFrame:
    """Counts of a base / platform / tissue template: one rollup instead of a loop. A level without a name has no node of its own."""
    rolled = subjects.rollup(*levels).agg(F.count(member).alias("patient_count"), *[F.grouping(c).alias(f"__g_{i}") for i, c in enumerate(levels)])
    for i, c in enumerate(levels):
        rolled = rolled.where((F.col(f"__g_{i}") == 1) | F.col(c).isNotNull())
    pieces = [F.when(F.col(c).isNotNull(), F.concat(F.col(c), F.lit(P.SEP))).otherwise("") for c in levels]
    return rolled.select(F.concat(F.lit(base), *pieces).alias("path"), "patient_count")


def tags(links: DataFrame, tree: DataFrame, kind: str, key: str, source: str = "source", path: str = "path") -> DataFrame:
    """Shortest-sorting path per tagged key."""
    tops = tree.where(F.col(source).isNotNull()).groupBy(source).agg(F.min(path).alias(path))
    return links.join(tops, source).groupBy(key).agg(F.min(path).alias("path")).select(
        "path", F.lit(kind).alias("tag_type"), F.col(key).alias("tag")
    )


def assay_tree(samples: DataFrame, base: str, levels: list[str], root_level: int = 0) -> DataFrame:
    """Base, platform and tissue nodes of an array assay with level, attributes and sample counts."""
    leaf = P.build(*levels)
    full = samples.select(F.concat(F.lit(base.rstrip(P.SEP)), leaf).alias("path"), "sample_id")
    rolled = counts(full, "path", "sample_id").where(P.under("path", base))
    n_levels = base.count(P.SEP) - 1 + len(levels)
    return rolled.select(
        "path", P.level("path", root_level).alias("level"), P.leaf_name("path").alias("name"),
        F.when(P.depth("path") == n_levels, LEAF).otherwise(FOLDER).alias("attributes"),
        F.col("patient_count").alias("n_samples"),
    )

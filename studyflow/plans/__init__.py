"""Demonstration queries on the test tables, one module per operator group."""

from importlib import import_module

MODULES = [
    "rows_demo", "clinical_demo", "tree_demo", "sets_demo", "assay_demo", "snp_demo", "analysis_demo", "ontology_demo",
    "quality_demo",
]


def load_all():
    from studyflow.plans import registry

    for m in MODULES:
        import_module(f"studyflow.plans.{m}")
    return registry.QUERIES, registry.ORACLES

"""Hand-written tiny annotation tables (columns as in FIXTURES.md)."""

from annomart.sources.tables import Catalog

FEATURE = "feature_id long, uniquename string, name string, type_id long, organism_id long, is_analysis boolean, is_obsolete boolean"


def catalog(spark, **tables):
    base = {
        "cv": spark.createDataFrame([(1, "molecular_function"), (2, "relationship"), (3, "synonym type"),
                                     (4, "disease_ontology")], "cv_id long, name string"),
        "db": spark.createDataFrame([(1, "Annobase", None), (2, "GO", None), (3, "DOID", None)],
                                    "db_id long, name string, urlprefix string"),
        "cvterm": spark.createDataFrame([
            (1, 2, "alleleof", 0, 101), (2, 2, "associated_with", 0, 102), (3, 3, "symbol", 0, 103),
            (4, 3, "fullname", 0, 104), (5, 1, "gene", 0, 105), (6, 2, "has_reg_region", 0, 106),
            (7, 1, "derived_stock_Bloomington", 0, 107), (8, 1, "cyto_range", 1, 108), (9, 1, "allele", 0, 109),
        ], "cvterm_id long, cv_id long, name string, is_obsolete long, dbxref_id long"),
    }
    for ent, key in [("grp", "grp_id"), ("strain", "strain_id"), ("cell_line", "cell_line_id"),
                     ("humanhealth", "humanhealth_id"), ("library", "library_id")]:
        base[ent] = spark.createDataFrame([], f"{key} long, uniquename string, is_obsolete boolean")
        base[f"{ent}_synonym"] = spark.createDataFrame(
            [], f"{key} long, synonym_id long, is_current boolean, is_internal boolean")
        base[f"{ent}_pub"] = spark.createDataFrame([], f"{key} long, pub_id long")
    base["stock"] = spark.createDataFrame([], "stock_id long, uniquename string, is_obsolete boolean")
    base["stock_genotype"] = spark.createDataFrame([], "stock_id long, genotype_id long")
    base["genotype"] = spark.createDataFrame([], "genotype_id long, uniquename string")
    base.update(tables)
    return Catalog(spark, "/nonexistent", tables=base)

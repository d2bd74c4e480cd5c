"""Identifiers for the nodes of source lists, and compendium records from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cliquespark.plans.schema import NAMED_THING

# Prefixes that are passed through, the prefix of each source, and the class of each node type.
VALID_PREFIXES = ("NCBIGene", "DRUGBANK", "CHEMBL.COMPOUND", "PUBCHEM.COMPOUND", "GO", "UBERON", "REACTOME", "MONDO", "UMLS", "HP", "MESH", "OMIM", "DOID", "SNOMEDCT", "NCIT", "HGNC", "UNIPROT", "CTD")
SOURCE_PREFIXES = {"NCBI": "NCBIGene", "DrugBank": "DRUGBANK", "GO": "GO", "UBERON": "UBERON", "REACTOME": "REACTOME", "MONDO": "MONDO", "MONDO_grouped": "MONDO", "HPO": "HP", "CTD": "CTD"}
NODE_CLASSES = {
    "gene/protein": "biolink:Gene",
    "drug": "biolink:ChemicalEntity",
    "biological_process": "biolink:BiologicalProcess",
    "cellular_component": "biolink:CellularComponent",
    "molecular_function": "biolink:MolecularActivity",
    "anatomy": "biolink:AnatomicalEntity",
    "disease": "biolink:Disease",
    "effect/phenotype": "biolink:PhenotypicFeature",
    "pathway": "biolink:Pathway",
    "exposure": "biolink:NamedThing",
}
ATLAS = "http://mouse.brain-map.org/atlas/index.html#"


def stripped(value) -> Column:
    v = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.btrim(v, F.lit(" \t\n\x0b\x0c\r")), F.lit(""))


def looked_up(values: dict[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[key]


def map_biokde(node_id="node_id") -> Column:
    i = stripped(node_id)
    return F.when(i.startswith(ATLAS), F.concat(F.lit("ABA:"), F.substring_index(i, "#", -1)))


def map_ikraph(node_id="node_id", node_type="node_type") -> Column:
    i = stripped(node_id)
    return F.when((F.col(node_type) == "Gene") & i.startswith("NCBI:"), i)


def map_primekg(node_id="node_id", node_type="node_type") -> Column:
    i, t = stripped(node_id), stripped(node_type)
    return F.when(t == "gene/protein", F.concat(F.lit("NCBIGene:"), i)).when(t == "disease", F.concat(F.lit("MONDO:"), i)).when(t == "drug", F.concat(F.lit("CHEBI:"), i))


def map_semmeddb(node_id="node_id") -> Column:
    i = stripped(node_id)
    return F.when(i.rlike(r"^C\p{Nd}{7}$"), F.concat(F.lit("UMLS:"), i))


def map_by_source(node_id="node_id", node_source="node_source") -> Column:
    """An identifier with a known prefix passes in upper case; others get their source's prefix.

    The known prefix in mixed case never equals an upper-cased one, so its identifiers get the prefix again.
    """
    i, source = stripped(node_id), stripped(node_source)
    known = i.contains(":") & F.upper(F.split(i, ":")[0]).isin(list(VALID_PREFIXES))
    return F.when(known, F.upper(i)).otherwise(F.concat(looked_up(SOURCE_PREFIXES, source), F.lit(":"), i))


def csv_record(rows: DataFrame, curie: Column, dataset: str) -> DataFrame:
    """Compendium records of a source list: ``type, identifiers, source``, the name of the dataset whatever the rows say; unmapped rows have none."""
    label = F.when(F.coalesce(F.col("node_name"), F.lit("")) != "", F.col("node_name")).otherwise(F.col("curie"))
    kind = F.when(F.coalesce(F.col("node_type"), F.lit("")) != "", F.concat(F.lit("biolink:"), "node_type")).otherwise(F.lit(NAMED_THING))
    return rows.withColumn("curie", curie).filter("curie IS NOT NULL").select(
        kind.alias("type"), F.array(F.struct(F.col("curie").alias("i"), label.alias("l"))).alias("identifiers"), F.lit(dataset.upper()).alias("source")
    )


def mapped_rows(rows: DataFrame) -> DataFrame:
    """Rows with ``curie`` (null where none is known) and ``class``."""
    return rows.withColumn("curie", map_by_source()).withColumn("class", F.coalesce(looked_up(NODE_CLASSES, F.coalesce("node_type", F.lit(""))), F.lit(NAMED_THING)))


def sample_per_type(rows: DataFrame, limit: int | None, position: str = "pos") -> DataFrame:
    """The first ``limit`` mapped rows of each type in input order; the limit prunes in each partition first."""
    mapped = mapped_rows(rows).filter("curie IS NOT NULL")
    if limit is None:
        return mapped
    nth = F.row_number().over(Window.partitionBy("node_type").orderBy(position))
    return mapped.withColumn("nth", nth).filter(F.col("nth") <= limit).drop("nth")


def compendium_records(rows: DataFrame, limit: int | None = None, position: str = "pos") -> DataFrame:
    named = F.when(F.coalesce(F.col("node_name"), F.lit("")) != "", F.col("node_name"))
    return sample_per_type(rows, limit, position).select(F.col("class").alias("type"), F.array(F.struct(F.col("curie").alias("i"), named.alias("l"))).alias("identifiers"))


def mapping_counts(rows: DataFrame) -> DataFrame:
    """``node_type, n_seen, n_mapped, percent``."""
    seen, found = F.count("*"), F.count("curie")
    return mapped_rows(rows).groupBy("node_type").agg(seen.alias("n_seen"), found.alias("n_mapped"), (100.0 * found / seen).alias("percent"))


def unmapped_examples(rows: DataFrame, limit: int = 5, position: str = "pos") -> DataFrame:
    """The first few unmapped rows of each type as text."""
    nth = F.row_number().over(Window.partitionBy("node_type").orderBy(position))
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    example = F.concat(blank("node_id"), F.lit(" ("), blank("node_name"), F.lit(") [source: "), blank("node_source"), F.lit("]"))
    return mapped_rows(rows).filter("curie IS NULL").withColumn("nth", nth).filter(F.col("nth") <= limit).select("node_type", "nth", example.alias("example"))


def mapping_totals(rows: DataFrame) -> DataFrame:
    """``n_seen, n_mapped, percent`` of all rows."""
    seen, found = F.count("*"), F.count("curie")
    return mapped_rows(rows).agg(seen.alias("n_seen"), found.alias("n_mapped"), F.when(seen > 0, 100.0 * found / seen).otherwise(F.lit(0.0)).alias("percent"))


def mapping_report(rows: DataFrame) -> dict[str, DataFrame]:
    """Totals, counts by type and unmapped examples; ``sinks.write_report`` writes them."""
    return {"totals": mapping_totals(rows), "types": mapping_counts(rows), "unmapped": unmapped_examples(rows)}

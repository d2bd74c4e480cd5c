"""Schemas and configuration of the normalization engine."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

IDENTIFIER = "struct<i: string, l: string, d: array<string>>"
COMPENDIUM = f"type string, ic string, identifiers array<{IDENTIFIER}>"
EQUIVALENT = "struct<identifier: string, label: string, description: string, type: string>"

NAMED_THING = "biolink:NamedThing"
ENTITY = "biolink:Entity"
GENE_PROTEIN, DRUG_CHEMICAL = "GeneProtein", "DrugChemical"
#: Order matters: members of the first come before those of the second.
ALLOWED_CONFLATIONS = (GENE_PROTEIN, DRUG_CHEMICAL)

# The prefixes that are preferred for labels of a type, and the label length from which shorter labels win.
BOOST_PREFIXES = {"biolink:ChemicalEntity": ("DRUGBANK", "DrugCentral", "CHEBI", "MESH", "CHEMBL.COMPOUND", "GTOPDB", "HMDB", "RXCUI", "PUBCHEM.COMPOUND")}
DEMOTE_LABELS_LONGER_THAN = 15


@dataclass(frozen=True)
class Config:
    """What a deployment may change."""

    boost_prefixes: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(BOOST_PREFIXES))
    demote_labels_longer_than: int = DEMOTE_LABELS_LONGER_THAN
    conflations: tuple[str, ...] = ALLOWED_CONFLATIONS
    named_thing: str = NAMED_THING
    entity: str = ENTITY


@dataclass(frozen=True)
class Index:
    """The lookup tables; every operator takes one, none keeps state.

    ``curie_map(curie_key, canonical_id)``, ``cliques(canonical_id, type, ic, ic_raw, identifiers)``,
    ``type_ancestors(type, ancestors)``, ``conflation(name, member, members)`` and
    ``prefix_counts(file, semantic_type, prefix, cnt)``.
    """

    curie_map: DataFrame
    cliques: DataFrame
    type_ancestors: DataFrame
    conflation: DataFrame
    prefix_counts: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {"curie_map": self.curie_map, "cliques": self.cliques, "type_ancestors": self.type_ancestors, "conflation": self.conflation, "prefix_counts": self.prefix_counts}

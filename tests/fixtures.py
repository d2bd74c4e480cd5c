"""A small index: water, a lung disease, a gene, and cases that differ by spelling, label or description."""

from cliquespark.operators.index import build_index

CLIQUE = "file string, file_idx int, line_no long, type string, ic string, identifiers array<struct<i: string, l: string, d: array<string>>>"
CHEMICAL = ["biolink:SmallMolecule", "biolink:MolecularEntity", "biolink:ChemicalEntity", "biolink:PhysicalEssence", "biolink:NamedThing", "biolink:Entity"]


def clique(line, kind, *ids, ic=None, file_idx=0):
    return (f"f{file_idx}", file_idx, line, kind, ic, [(i, label, text) for i, label, text in ids])


CLIQUES = [
    clique(0, "biolink:Disease", ("MONDO:0005002", None, None), ("DOID:3812", None, None), ic="78.35"),
    clique(1, "biolink:SmallMolecule", ("PUBCHEM.COMPOUND:10129877", "WATER O 15", None), ("UNII:63M8RYN44N", "WATER O-15", ["a kind of water", "x"]), ic="0.25"),
    clique(2, "biolink:SmallMolecule", ("CHEBI:15377", "WATER", []), ic="47.7"),
    clique(3, None, ("X:1", "CHEMBL123", None), ("X:2", "a label that is rather long", None), ("DRUGBANK:9", "drug", ["described"])),
    clique(4, "biolink:Gene", ("NCBIGene:9496", "TBX4", None), ("HGNC:11603", None, None), ("nocolon", "n", None)),
    clique(5, "biolink:Protein", ("UniProtKB:P1", "", None), ("PR:1", "protein name", None)),
    clique(0, "biolink:Disease", ("MONDO:0005003", "later", None), ("doid:3813", "x", None), file_idx=1),
    clique(1, "biolink:Disease", ("MONDO:0000009", "old", None), ("SAME:1", None, None), ic="1.05", file_idx=1),
    clique(2, "biolink:Disease", ("MONDO:0000010", "new", None), ("same:1", None, None), ("MONDO:0000009", None, None), file_idx=1),
]
ANCESTORS = [
    ("biolink:Disease", ["biolink:Disease", "biolink:NamedThing", "biolink:Entity"]),
    ("biolink:SmallMolecule", CHEMICAL),
    ("biolink:Gene", ["biolink:Gene", "biolink:NamedThing"]),
    ("biolink:Protein", ["biolink:Protein", "biolink:NamedThing"]),
]
LISTS = [("DrugChemical", ["CHEBI:15377", "PUBCHEM.COMPOUND:10129877"]), ("GeneProtein", ["UniProtKB:P1", "NCBIGene:9496"])]


def small_index(spark):
    conflation = [(name, m, members) for name, members in LISTS for m in members]
    return build_index(
        spark.createDataFrame(CLIQUES, CLIQUE), spark.createDataFrame(conflation, "name string, member string, members array<string>"), spark.createDataFrame(ANCESTORS, "type string, ancestors array<string>")
    )

"""Normalization of a stream of identifiers against a static index."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cliquespark.functions.exprs import curie_key
from cliquespark.operators.normalize import canonical_nodes
from cliquespark.plans.schema import Config, Index
from cliquespark.sources.tables import materialize


def answer_table(index: Index, conflations: tuple[str, ...] = (), descriptions: bool = False, individual_types: bool = False, config: Config | None = None) -> DataFrame:
    """The node of every canonical identifier, written once: what each batch of a stream looks up."""
    nodes = canonical_nodes(index.cliques.select("canonical_id"), index, list(conflations), descriptions, individual_types, config or Config())
    return materialize(nodes, "answers")


def normalize_stream(curies: DataFrame, index: Index, answers: DataFrame | None = None, column: str = "curie") -> DataFrame:
    """Each arriving identifier with its node, null where it is unknown: stream-static left joins, no state and no watermark."""
    answers = answer_table(index) if answers is None else answers
    keyed = curies.withColumn("curie_key", curie_key(column))
    return keyed.join(index.curie_map, "curie_key", "left").join(answers, "canonical_id", "left").drop("curie_key")

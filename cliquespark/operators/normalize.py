"""Identifier normalization: one plan of joins for any number of identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliquespark.functions.exprs import curie_key, preferred_label
from cliquespark.operators.index import ancestors_or_fallback
from cliquespark.plans.schema import DRUG_CHEMICAL, EQUIVALENT, GENE_PROTEIN, Config, Index


def typed_cliques(index: Index, config: Config) -> DataFrame:
    """Cliques with the ancestors of their type."""
    return index.cliques.join(index.type_ancestors, "type", "left").withColumn("ancestors", ancestors_or_fallback(F.col("type"), F.col("ancestors"), config.named_thing))


def resolve(curies: DataFrame, index: Index, column: str = "curie") -> DataFrame:
    """``curie, canonical_id``: one row per distinct input, null where it is unknown."""
    inputs = curies.select(F.col(column).alias("curie")).distinct().withColumn("curie_key", curie_key("curie"))
    return inputs.join(index.curie_map, "curie_key", "left").select("curie", "canonical_id")


def conflated_parts(canonicals: DataFrame, cliques: DataFrame, index: Index, names: list[str]) -> DataFrame:
    """``canonical_id, parts``: the cliques of all members, in the order of the conflations and their lists."""
    order = F.create_map(*[x for k, n in enumerate(names) for x in (F.lit(n), F.lit(k))])
    lists = index.conflation.filter(F.col("name").isin(names)).select(F.col("member").alias("canonical_id"), order[F.col("name")].alias("ord"), "members")
    members = canonicals.join(lists, "canonical_id").select("canonical_id", "ord", F.posexplode("members").alias("pos", "member"))
    found = members.join(cliques.withColumnRenamed("canonical_id", "member"), "member")
    part = F.struct("ord", "pos", "type", "ancestors", "identifiers")
    return found.groupBy("canonical_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))


def canonical_nodes(canonicals: DataFrame, index: Index, names: list[str], descriptions: bool, individual_types: bool, config: Config) -> DataFrame:
    """Nodes of distinct canonical identifiers."""
    cliques = typed_cliques(index, config)
    own = canonicals.join(cliques, "canonical_id")
    part = F.struct(F.lit(0).alias("ord"), F.lit(0).alias("pos"), "type", "ancestors", "identifiers")
    nodes = own.select("canonical_id", F.col("ic").alias("information_content"), F.array(part).alias("own"))
    if names:
        lists = conflated_parts(canonicals, cliques.select("canonical_id", "type", "ancestors", "identifiers"), index, names)
        nodes = nodes.join(lists, "canonical_id", "left").withColumn("parts", F.coalesce("parts", "own"))
    else:
        nodes = nodes.withColumn("parts", F.col("own"))
    return create_node(nodes, bool(names), descriptions, individual_types, config)


def create_node(nodes: DataFrame, conflating: bool, descriptions: bool, individual_types: bool, config: Config) -> DataFrame:
    """The answer's columns from ``parts``, the cliques that make up a node."""
    typed = F.flatten(F.transform("parts", lambda p: F.transform(p["identifiers"], lambda x: F.struct(x["i"].alias("i"), x["l"].alias("l"), x["d"].alias("d"), p["type"].alias("t")))))
    # types before the general one is taken out decide about labels
    nodes = nodes.withColumns({"eqids": typed, "all_types": F.array_distinct(F.flatten(F.transform("parts", lambda p: p["ancestors"])))})
    if conflating:
        has_label = lambda p: F.exists(p["identifiers"], lambda x: F.coalesce(x["l"], F.lit("")) != "")
        labelled = F.coalesce(F.get(F.filter("parts", has_label), F.lit(0)), F.element_at("parts", -1))["identifiers"]
    else:
        labelled = F.col("eqids")
    label = preferred_label(labelled, F.col("all_types"), config.boost_prefixes, config.demote_labels_longer_than)
    first_text = lambda d: F.get(d, F.lit(0))

    def equivalent(x: Column) -> Column:
        description = first_text(x["d"]) if descriptions else F.lit(None).cast("string")
        kind = x["t"] if individual_types else F.lit(None).cast("string")
        return F.struct(x["i"].alias("identifier"), x["l"].alias("label"), description.alias("description"), kind.alias("type"))

    described = first_text(F.filter("eqids", lambda x: F.size(F.coalesce(x["d"], F.array().cast("array<string>"))) > 0))
    return nodes.select(
        "canonical_id",
        F.get("eqids", F.lit(0))["i"].alias("identifier"),
        label.alias("label"),
        (first_text(described["d"]) if descriptions else F.lit(None).cast("string")).alias("description"),
        F.transform("eqids", equivalent).cast(f"array<{EQUIVALENT}>").alias("equivalent_identifiers"),
        F.array_remove("all_types", config.entity).alias("types"),
        "information_content",
    )


def normalize(
    curies: DataFrame,
    index: Index,
    conflate: bool = True,
    drug_chemical_conflate: bool = False,
    descriptions: bool = False,
    individual_types: bool = False,
    config: Config | None = None,
    conflations: list[str] | None = None,
    column: str = "curie",
) -> DataFrame:
    """One row per distinct input: ``curie, canonical_id, identifier, label, description, equivalent_identifiers, types, information_content``.

    ``identifier`` is null for unknown inputs. Each canonical identifier is built once, so an
    answer does not depend on what else is asked. ``conflations`` replaces the two flags by names.
    """
    config = config or Config()
    names = conflations if conflations is not None else [n for n, on in ((GENE_PROTEIN, conflate), (DRUG_CHEMICAL, drug_chemical_conflate)) if on]
    resolved = resolve(curies, index, column)
    canonicals = resolved.filter("canonical_id IS NOT NULL").select("canonical_id").distinct()
    nodes = canonical_nodes(canonicals, index, names, descriptions, individual_types, config)
    return resolved.join(nodes, "canonical_id", "left").select("curie", "canonical_id", "identifier", "label", "description", "equivalent_identifiers", "types", "information_content")


def normalize_small(curies: DataFrame, index: Index, **options) -> DataFrame:
    """As :func:`normalize` for few inputs against a large index.

    A left join cannot send its left side out, so the index is first cut to what the inputs name:
    the optimizer may then broadcast the inputs if their measured size allows it.
    """
    from dataclasses import replace

    column = options.get("column", "curie")
    keys = curies.select(curie_key(F.col(column)).alias("curie_key")).distinct()
    cut = index.curie_map.join(keys, "curie_key", "left_semi")
    return normalize(curies, replace(index, curie_map=cut), **options)


def ic_attribute(ic) -> Column:
    """The attribute that carries an information content, null for none."""
    value = F.col(ic) if isinstance(ic, str) else ic
    return F.when(
        value.isNotNull(),
        F.create_map(
            F.lit("attribute_type_id"), F.lit("biolink:has_numeric_value"), F.lit("original_attribute_name"), F.lit("information_content"), F.lit("value_type_id"), F.lit("EDAM:data_0006"), F.lit("value"), value.cast("string")
        ),
    )


def hit_rate(nodes: DataFrame) -> DataFrame:
    """``n_found, n_total, rate``."""
    found, total = F.count("identifier"), F.count("*")
    return nodes.agg(found.alias("n_found"), total.alias("n_total"), F.when(total > 0, found / total).otherwise(F.lit(0.0)).alias("rate"))

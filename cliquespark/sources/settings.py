"""A deployment's settings as JSON: where the files are, which are read in which order, the conflations, and how labels are chosen."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession

from cliquespark.operators.index import build_index
from cliquespark.plans.schema import BOOST_PREFIXES, DEMOTE_LABELS_LONGER_THAN, Config, Index
from cliquespark.sources.scan import compendium_paths, scan_compendium, scan_conflation


@dataclass(frozen=True)
class Settings:
    """``data_files`` in order of writing; ``conflations`` by name with their file, in order of precedence."""

    compendium_directory: str
    conflation_directory: str
    data_files: tuple[str, ...]
    conflations: tuple[tuple[str, str], ...]
    dry_run: bool = False
    config: Config = field(default_factory=Config)


def load_settings(spark: SparkSession, path: str) -> Settings:
    """From a JSON file at any path that Spark reads; keys that only name servers are left out, a conflation is named after its file."""
    found = json.loads(spark.read.text(path, wholetext=True).first()[0])
    lists = tuple((PurePosixPath(c["file"]).stem, c["file"]) for c in found.get("conflations", []))
    config = Config(
        boost_prefixes={t: tuple(prefixes) for t, prefixes in found["preferred_name_boost_prefixes"].items()} if "preferred_name_boost_prefixes" in found else dict(BOOST_PREFIXES),
        demote_labels_longer_than=found.get("demote_labels_longer_than", DEMOTE_LABELS_LONGER_THAN),
        conflations=tuple(name for name, _ in lists),
    )
    return Settings(found["compendium_directory"], found.get("conflation_directory", ""), tuple(found["data_files"]), lists, bool(found.get("test_mode", 0)), config)


def scan_all(spark: SparkSession, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Cliques and conflation lists of all files that the settings name."""
    cliques = scan_compendium(spark, compendium_paths(settings.compendium_directory, settings.data_files))
    lists = [scan_conflation(spark, path, name) for (name, _), path in zip(settings.conflations, compendium_paths(settings.conflation_directory, [f for _, f in settings.conflations]), strict=True)]
    empty = spark.createDataFrame([], "name string, member string, members array<string>")
    return cliques, reduce(DataFrame.unionByName, lists, empty)


def index_from_settings(spark: SparkSession, settings: Settings, type_ancestors: DataFrame) -> Index:
    return build_index(*scan_all(spark, settings), type_ancestors)

"""Readers: compendium and conflation files, source node lists, normalized documents."""

from __future__ import annotations

import json
import re
import warnings
from collections.abc import Iterable
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliquespark.plans.schema import COMPENDIUM

SAMPLE_LINES = 5
NODE = "struct<id: struct<identifier: string, label: string, description: string>, equivalent_identifiers: array<struct<identifier: string, label: string, description: string, type: string>>, type: array<string>, information_content: double>"


class InvalidFile(ValueError):
    """A file that is empty or does not look like what it should be."""


def compendium_paths(folder: str, names: Iterable[str]) -> list[str]:
    """Paths in configured order; the order decides which of two entries wins."""
    return [f"{folder.rstrip('/')}/{n}" for n in names]


def qualified(spark: SparkSession, path: str) -> tuple[str, bool]:
    """A path as readers report it, and whether it exists."""
    jvm = spark._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    system = found.getFileSystem(spark._jsc.hadoopConfiguration())
    return re.sub("^([A-Za-z0-9]+):/+", r"\1:/", system.makeQualified(found).toUri().toString()), system.exists(found)


def present(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths that exist; a missing one is warned of."""
    found = []
    for p in paths:
        if qualified(spark, p)[1]:
            found.append(p)
        else:
            warnings.warn(f"file not found: {PurePosixPath(p).name}", stacklevel=3)
    return found


def is_compendium(spark: SparkSession, path: str, lines: int = SAMPLE_LINES) -> bool:
    """Whether the first lines are cliques: a text ``type`` and a list of ``identifiers``. An empty file is an error."""
    head = [r[0] for r in spark.read.text(path).limit(lines).collect()]
    if not head:
        raise InvalidFile(f"{path} is empty")
    try:
        records = [json.loads(x) for x in head]
    except ValueError:
        return False
    return all(isinstance(r, dict) and isinstance(r.get("type"), str) and isinstance(r.get("identifiers"), list) for r in records)


def invalid_lines(scanned: DataFrame) -> DataFrame:
    """Every line that lacks a type, identifiers, or an identifier's text: the full check."""
    bad = F.col("type").isNull() | F.col("identifiers").isNull() | F.exists("identifiers", lambda x: x["i"].isNull())
    return scanned.filter(F.coalesce(bad, F.lit(True)))


def scan_compendium(spark: SparkSession, paths: list[str], strict: bool = False) -> DataFrame:
    """Cliques of several files: ``file, file_idx, line_no, type, ic, identifiers``.

    Missing files are warned of and skipped, as are files that fail the sample check (``strict``: both
    are refused); an empty file is refused. ``file_idx`` is the place in ``paths``, and ``line_no``
    orders the lines of a file within this scan; it is not a count of lines.
    """
    there = present(spark, paths)
    good = [p for p in there if is_compendium(spark, p)]
    if strict and len(good) < len(paths):
        raise InvalidFile(f"not compendia: {sorted(set(paths) - set(good))}")
    schema = f"file string, file_idx int, line_no struct<block: bigint, line: bigint>, {COMPENDIUM}"
    if not good:
        return spark.createDataFrame([], schema)
    places = [x for p in good for x in (F.lit(qualified(spark, p)[0]), F.lit(paths.index(p)))]
    name = F.regexp_replace("file", "^([A-Za-z0-9]+):/+", "$1:/")
    lines = spark.read.text(good).select(
        F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("line_no"), F.from_json("value", COMPENDIUM).alias("r")
    )
    return lines.select("file", F.create_map(*places)[name].cast("int").alias("file_idx"), "line_no", "r.*")


def scan_conflation(spark: SparkSession, path: str, name: str) -> DataFrame:
    """``name, member, members``: the whole list under each of its members; of two lists with a member the later wins."""
    lines = spark.read.text(path).select(F.struct(F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("l")).alias("at"), F.from_json("value", "array<string>").alias("members"))
    if lines.isEmpty():
        raise InvalidFile(f"{path} is empty")
    return keyed_conflation(lines.withColumn("name", F.lit(name)))


def keyed_conflation(lists: DataFrame) -> DataFrame:
    """From lists (``name, at, members``) to one row per member."""
    exploded = lists.filter("members IS NOT NULL").select("name", "at", "members", F.explode("members").alias("member"))
    return exploded.groupBy("name", "member").agg(F.max_by("members", "at").alias("members"))


def scan_normalized(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """A document ``{curie: node}`` as rows ``entity_id, id, equivalent_identifiers, type, information_content``.

    A document is one value and so one task; ``lines`` reads files with such an object on each line,
    which are split like any others. Identifiers without a node have null parts.
    """
    found = spark.read.text(path, wholetext=not lines).select(F.from_json("value", f"map<string, {NODE}>").alias("m"))
    return found.select(F.explode("m").alias("entity_id", "node")).select("entity_id", "node.*")


def scan_curies(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Column ``input_curie`` of a CSV file, trimmed, blanks skipped; ``limit`` counts the first rows of the file, blanks included."""
    rows = spark.read.csv(path, header=True)
    if limit is not None:
        rows = rows.select("input_curie", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("n")).orderBy("f", "b", "n").limit(limit)
    return rows.select(F.trim("input_curie").alias("curie")).filter("curie <> ''")


def _positional(spark: SparkSession, path: str, least: int, columns: int) -> DataFrame:
    """Columns ``c0``, ``c1`` and so on of headerless CSV lines with at least so many fields; empty fields are empty texts, absent ones null."""
    lines = spark.read.text(path)
    bare = F.regexp_replace("value", r'(^|,)"(?:[^"]|"")*"', "$1")
    lines = lines.select("value", (F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1).alias("n")).filter((F.col("n") >= least) & (F.col("value") != ""))
    row = F.from_csv("value", F.lit(", ".join(f"c{k} string" for k in range(columns))), {"escape": '"', "maxCharsPerColumn": "-1"})
    fields = lines.select("n", row.alias("r"))
    return fields.select(*[F.when(F.col("n") > k, F.coalesce(F.col("r")[f"c{k}"], F.lit(""))).alias(f"c{k}") for k in range(columns)])


def _named(spark: SparkSession, path: str, source: str | None, node_id: str, node_type: str, node_name: str) -> DataFrame:
    """Columns of CSV files with a header; empty fields are empty texts."""
    rows = spark.read.csv(path, header=True, escape='"')
    value = lambda c: F.coalesce(F.col(c), F.lit(""))
    return rows.select(value(node_id).alias("node_id"), value(node_type).alias("node_type"), value(node_name).alias("node_name"), (F.lit(source) if source else value("node_source")).alias("node_source"))


def scan_biokde(spark: SparkSession, path: str) -> DataFrame:
    """Headerless; rows of fewer than eight fields are skipped, empty ones count; a ninth names the source."""
    rows = _positional(spark, path, 8, 9)
    return rows.select(F.col("c0").alias("node_id"), F.col("c1").alias("node_type"), F.col("c5").alias("node_name"), F.coalesce("c8", F.lit("BioKDE")).alias("node_source"))


def scan_ikraph(spark: SparkSession, path: str) -> DataFrame:
    return _named(spark, path, "iKGraph", "external_id", "type", "official_name")


def scan_primekg(spark: SparkSession, path: str) -> DataFrame:
    return _named(spark, path, "PrimeKG", "node_id", "node_type", "node_name")


def scan_primekg_sources(spark: SparkSession, path: str) -> DataFrame:
    return _named(spark, path, None, "node_id", "node_type", "node_name")


def scan_semmeddb(spark: SparkSession, path: str) -> DataFrame:
    """Headerless; rows of fewer than thirteen fields are skipped, empty ones count; the thirteenth is the source."""
    rows = _positional(spark, path, 13, 13)
    return rows.select(F.col("c3").alias("node_id"), F.col("c5").alias("node_type"), F.col("c4").alias("node_name"), F.col("c12").alias("node_source"))

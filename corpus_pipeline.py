"""From raw documents to packed training sequences, a stage at a time.

Each stage gets all that its predecessor kept and its decisions take effect. All but the last
return the columns of ``documents``. Counted as part of the ``llm`` subpackage.

Defined results, for every stage: each row is judged on its own text, whether its ``doc_id`` is null,
repeated or neither, so that no decision on one row takes another with it; only line dedup
counts rows of one id as one document, as its contract does. Null texts count as empty; the quality
rules reject them. Ties go by the operators' own rules, among them the smallest ``doc_id`` for lines
and near copies. Very long texts are worked on in whole. Empty tables give empty tables. Other columns
pass through whatever their names, up to the last stage, whose rows are pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliquespark.llm import decontamination, linededup, neardup, packing, quality
from cliquespark.llm.shared import documents, materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.judge(docs, rows=True).filter("kept").select("row.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; documents of which nothing but white space is left go with them."""
    rest = linededup.dedup_lines(docs)
    if "n_chars" in rest.columns:
        rest = rest.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rest.filter(F.btrim("text", F.lit(linededup.SPACE)) != "")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one of the smallest id."""
    return neardup.representatives(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontamination.clean(docs, documents(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is packed into sequences."""
    return packing.packed_digests(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("best_fit_packing", packing_stage),
]

#: Tokenization and alignment have no SQL form; tests compare ``run`` with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

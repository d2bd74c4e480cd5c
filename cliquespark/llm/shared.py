"""Helpers that every corpus operator uses: input columns and tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliquespark.sources.shipping import ship_package
from cliquespark.sources.tables import materialize, shared_dir, shared_path

__all__ = ["documents", "materialize", "shared_dir", "shared_path", "ship_package", "texts"]


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text``, so that other columns can neither clash nor be read."""
    ship_package(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

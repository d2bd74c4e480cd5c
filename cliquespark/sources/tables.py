"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


ROWS_PER_FILE = 250_000
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1_000
#: Tables that each application has written; frames that read them stay usable until :func:`release`.
_WRITTEN: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where a local session names none, as in tests, a temporary folder is set once and removed at the end.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="cliquespark-")
        spark.conf.set("spark.checkpoint.dir", found)
        atexit.register(shutil.rmtree, found.removeprefix("file://"), True)
    return found.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`shared_dir`."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows go to Python workers by the thousand while a table is written; with whole texts a default batch takes tens of MB on either side."""
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def materialize(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage at a table that survives the loss of any executor and
    keeps an expensive plan from running twice. Where about how many ``rows`` there are is known, the
    table has no more files than so many rows need, however many partitions the shuffle before it has.
    """
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_PER_FILE)))
    path = shared_path(df.sparkSession, label)
    _WRITTEN.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    with small_batches(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Remove the intermediate tables that this session wrote, once no frame that reads them is needed; how many there were."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(paths)

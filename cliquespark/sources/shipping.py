"""Makes this package importable in Python workers, wherever they run."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add the package's sources to the application once; executors fetch them from the driver."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    package = Path(__file__).resolve().parents[1]
    if not package.is_dir():
        return
    target = Path(tempfile.mkdtemp(prefix="cliquespark-src-")) / "cliquespark-src.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    context.addPyFile(str(target))

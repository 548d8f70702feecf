"""Send this package to the Python workers of a session, so that they need no installed copy of it."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).resolve().parents[1]
_SENT: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Once per application: the package as a zip file that Spark hands to every worker."""
    application = spark.sparkContext.applicationId
    if application in _SENT:
        return
    _SENT[application] = tempfile.TemporaryDirectory(prefix="dayloom-code-")
    path = f"{_SENT[application].name}/{_PACKAGE.name}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(_PACKAGE.rglob("*.py")):
            archive.write(source, source.relative_to(_PACKAGE.parent))
    spark.sparkContext.addPyFile(path)


def shipped(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``build(spark, ...)`` with the package sent first."""

    @functools.wraps(build)
    def run(spark: SparkSession, *args) -> DataFrame:
        ship(spark)
        return build(spark, *args)

    return run

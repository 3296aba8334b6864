"""Prepares a session: settings, and the package for the Python workers, as ``--py-files`` would send it."""

from __future__ import annotations

import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from riskloom.session import configure

PACKAGE = Path(__file__).resolve().parents[1]
# Documents in an Arrow batch, so that Python workers hold little at a time.
ARROW_RECORDS = "1000"
# A table of intermediate rows is sized by its files; in a broadcast its rows take about ten times that.
BROADCAST_BYTES = 2 << 20
_sent: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add the package's sources to the session's Python files, once per application."""
    application = spark.sparkContext.applicationId
    if application in _sent:
        return
    target = Path(tempfile.mkdtemp(prefix=f"{PACKAGE.name}-")) / f"{PACKAGE.name}.zip"  # on the driver, which serves it
    with zipfile.ZipFile(target, "w") as bundle:
        for source in sorted(PACKAGE.rglob("*.py")):
            bundle.write(source, source.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(str(target))
    _sent.add(application)


def bound_broadcasts(spark: SparkSession) -> None:
    """Lower the size up to which sides are broadcast unasked to ``BROADCAST_BYTES``; a lower one stays, -1 too."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    number, unit = re.match(r"(-?\d+)([a-z]?)", spark.conf.get(key).lower()).groups()
    if int(number) << 10 * "bkmgtp".index(unit or "b") > BROADCAST_BYTES:
        spark.conf.set(key, str(BROADCAST_BYTES))


def prepare(spark: SparkSession) -> SparkSession:
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_RECORDS)
    bound_broadcasts(spark)
    return configure(spark)

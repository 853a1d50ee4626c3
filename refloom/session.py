"""Make this package importable on executors, whatever path the driver found it on."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


#: Rows and bytes that go to Python at a time: texts may be long, and what a worker holds is to stay small.
ARROW_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4194304"}


def ship_package(spark: SparkSession) -> None:
    """Send the package to all executors, once per application, and bound the batches that go to Python."""
    for key, value in ARROW_LIMITS.items():
        if spark.conf.get(key, None) in (None, "10000", "268435456b", "268435456", "256MB", "256m"):  # not set otherwise
            spark.conf.set(key, value)
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="refloom-code-")) / "refloom_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(top.rglob("*.py")):
            out.write(path, f"{top.name}/{path.relative_to(top)}")
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def shared_path(spark: SparkSession, what: str) -> str:
    """A new path in the folder that driver and executors share; one of our own where all is one process and none is set."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{shared or 'file://' + tempfile.mkdtemp(prefix='refloom-')}/{what}-{uuid.uuid4().hex}"

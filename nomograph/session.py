"""Sessions, and what executors need to run this package's Python."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SHIPPED = "nomograph_package.zip"


def session(app: str = "nomograph", **settings: str) -> SparkSession:
    """A session with this engine's settings: UTC, adaptive execution, and no reading of files by path in statements."""
    builder = SparkSession.builder.appName(app)
    for key, value in ({"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.ui.showConsoleProgress": "false"} | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Adds the package to the application's Python files, once: executors need no copy of the repository."""
    sc = spark.sparkContext
    if any(Path(f).name == SHIPPED for f in sc._python_includes):
        return
    top, to = Path(__file__).resolve().parent, Path(os.path.realpath(tempfile.mkdtemp(prefix="nomograph-"))) / SHIPPED
    with zipfile.ZipFile(to, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(str(to))


#: Rows and bytes of an Arrow batch. Texts can be long, so a batch holds far less than Spark's default. A longer text is a batch of its own.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Before Python runs on executors: gives them this package, and bounds a worker's memory by smaller Arrow batches. The
    settings stay with the session, as a plan reads them when it runs; they lower larger values only, and change no result."""
    ship(spark)
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(key, None)
        if now is None or not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Only where driver and executors are one process, a temporary one may stand in for it."""
    sc = spark.sparkContext
    known = sc.getCheckpointDir()
    if known is None:
        known = spark.conf.get("spark.checkpoint.dir", None)
        if known is None:
            if sc.master.split("[")[0] != "local":
                raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            known = tempfile.mkdtemp(prefix="nomograph-")
        sc.setCheckpointDir(known)
    return known


#: Tasks at least that dealt() makes.
TASKS = 64


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """df by keys, in as many tasks as the session's shuffles have. Adaptive execution puts parts together by their size as written: addresses shrink there to a tenth, and a task of 64 MB holds most of a GB once it is read."""
    return df.repartition(max(TASKS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys)


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared checkpoint folder and returns it without its lineage: for what a plan reads more than once, or an iteration hands on."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)

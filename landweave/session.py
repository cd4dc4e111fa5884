"""Session construction and the few session-level helpers the library shares."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings every plan here assumes: UTC, AQE, Arrow.

    Nothing overrides what a cluster has configured unless it is passed in.
    """
    builder = SparkSession.builder.appName("landweave")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.python.filterPushdown.enabled": "true",
        "spark.ui.enabled": "false",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables below sf_dir, by Spark's own reader so any store works; tasks get this package's code, too."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows of an Arrow batch; Spark's default would hold tens of megabytes of documents several times over.
BATCH_ROWS = "1000"


def ship(spark: SparkSession) -> None:
    """Give this package's code to the executors, once for each Spark context, and keep Arrow batches small.

    A batch size that the cluster's configuration sets is left as it is.
    """
    context = spark.sparkContext
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not context.getConf().contains(batch):
        spark.conf.set(batch, BATCH_ROWS)
    if getattr(context, "_landweave_shipped", False):
        return
    package = Path(__file__).resolve().parent
    # the driver serves the archive from here for as long as the context lives
    folder = tempfile.mkdtemp(prefix="landweave-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    staged = Path(folder, "code", package.name)
    shutil.copytree(package, staged, ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(f"{folder}/landweave", "zip", staged.parent))
    context._landweave_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors reach: spark.checkpoint.dir.

    Where it is unset, local mode gets a temporary folder for the session; a cluster gets an error,
    because what one machine writes in a folder of its own is missing on the others.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir is unset; on {master} it has to name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="landweave-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def held(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet in the shared folder and read back, for plans that need it more than once."""
    path = f"{shared_folder(df.sparkSession)}/landweave/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *columns: str) -> DataFrame:
    """Rows that are small but cost much, over all tasks; a count that is given isn't made smaller at run time."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def local_cpus() -> int:
    return int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))

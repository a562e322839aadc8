"""Session helpers."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, app: str = "plinth") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PLINTH_DRIVER_MEMORY", "8g"))
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the driver's Parquet tables, by any path Spark can read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, what: str) -> str:
    """A fresh path in the folder that driver and executors share: the checkpoint folder, or on one machine a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = f"file://{tempfile.gettempdir()}/plinth-checkpoints"
    return f"{found.rstrip('/')}/plinth-{what}-{uuid.uuid4().hex}"


def staged(df: DataFrame, what: str) -> DataFrame:
    """A table written to the shared folder and read back: what is used several times is planned and run once, and survives lost executors."""
    path = scratch(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, so that Python workers can import it anywhere."""
    context = spark.sparkContext
    if getattr(context, "_plinth_shipped", False):
        return
    here = Path(__file__).resolve().parent
    with tempfile.TemporaryDirectory() as folder:
        base = Path(folder, "stage")
        shutil.copytree(here, base / here.name, ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(str(Path(tempfile.mkdtemp(), "plinth-package")), "zip", base))
    context._plinth_shipped = True

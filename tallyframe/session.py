"""Session helpers: table access, durable lineage cuts, test sessions."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Sends this package to the workers, once for each context, wherever they and the driver were started.

    Each operator whose code runs on the workers calls it first."""
    sc = spark.sparkContext
    if getattr(sc, "_tallyframe_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="tallyframe-"), "tallyframe-package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, str(path.relative_to(root.parent)))
    sc.addPyFile(archive)
    sc._tallyframe_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table `name` below `sf_dir`, whole."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from `spark.checkpoint.dir`.

    Where the setting is absent, a session on one machine gets a folder there; a cluster is refused, as no folder of one
    of its machines would do."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="tallyframe-checkpoint-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared)
    return shared


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Materialise `df` in the shared folder, so that the loss of an executor loses no data."""
    ship(df.sparkSession)
    shared_dir(df.sparkSession)
    return df.checkpoint(eager)


def local_session(app: str = "tallyframe", cores: str = "*", shuffle_partitions: int = 8, memory: str = "4g") -> SparkSession:
    """A session for tests and the local bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tallyframe-checkpoint-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )

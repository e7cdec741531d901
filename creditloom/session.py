"""Sessions: settings that queries rely on, and sending this package to the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}

_shipped: set[str] = set()


def session(name: str = "creditloom", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings that queries rely on; others by name, with _ for dots."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("_", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send the sources of this package to the executors, once an application: Python functions of it run there."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        top = Path(__file__).resolve().parent
        archive = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{top.name}.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(top.rglob("*.py")):
                out.write(file, file.relative_to(top.parent))
        sc.addPyFile(archive)
        _shipped.add(sc.applicationId)


def saved(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage by a checkpoint in the folder of spark.checkpoint.dir.

    Without that setting a local session gets a folder of its own; on a cluster, where such a folder could not be read
    by others, it is an error."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint(eager=True)

"""Session factory and the shared work folder."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", app: str = "textloom", **conf: str) -> SparkSession:
    """A session with adaptive execution; partitions are Spark's default, sized by AQE at run time, unless ``conf`` says otherwise."""
    b = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    return share_package(b.getOrCreate())


def share_package(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package wherever the driver was started from."""
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        env["PYTHONPATH"] = os.pathsep.join([home, *paths])
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run of one operator, inside the cluster's shared folder.

    The shared folder is the session's spark.checkpoint.dir. Only where that is
    unset and the master is local (tests, one machine) a local folder is chosen and set.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError(f"{CHECKPOINT_KEY} must name a folder that all executors share")
        root = "file://" + os.path.join(tempfile.gettempdir(), f"textloom-{os.getuid()}")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/textloom/{name}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    """Hadoop's file system of a path and the path, for any store that the cluster knows."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    fs, place = _folder(spark, path)
    fs.delete(place, True)


def finished_runs(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the folders run=N under ``path`` that were written to their end, in order."""
    fs, place = _folder(spark, path)
    if not fs.exists(place):
        return []
    names = [f.getPath() for f in fs.listStatus(place)]
    done = [p for p in names if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName().partition("=")[2]) for p in done if p.getName().startswith("run="))


def written(df: DataFrame, path: str) -> DataFrame:
    """``df``, written as a table to ``path`` and read back."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as a table in the shared folder and read it back."""
    return written(df, shared_dir(df.sparkSession, name))


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of finished steps that nothing refers to."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data folder."""
    return share_package(spark).read.parquet(f"{sf_dir}/{name}.parquet")

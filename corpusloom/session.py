"""Session helpers: settings for local runs and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

_scopes: list[list[str]] = []


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the tests and the benchmark use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusloom")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


@lru_cache(maxsize=1)
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="corpusloom-")


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names it. Only under a local master, where all tasks share one machine, a local folder is made if it is unset.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not is_local(spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return named or _own_dir()


def is_local(master: str) -> bool:
    """Do all tasks run in the driver's process? ``local-cluster`` has executors of its own."""
    return master == "local" or master.startswith("local[")


def new_dir(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call gets."""
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for kept in _scopes:
        kept.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession):
    """Remove, at its end, the tables that were written in the shared folder inside it.

    Results that still read them must have been written or collected by then.
    """
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield paths
    finally:
        _scopes.remove(paths)
        jvm = spark.sparkContext._jvm
        for path in paths:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage.

    The files survive the loss of executors.
    """
    spark = df.sparkSession
    path = new_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

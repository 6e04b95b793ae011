"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Names given out by this process and not released yet.
_FOLDERS: list[str] = []
_TABLES: list[str] = []


def build_session(app: str = "logweir", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC times and adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under ``spark.checkpoint.dir``, the folder all executors share.

    Only a local session may leave that setting unset; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="logweir-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _FOLDERS.append(path)
    return path


def scratch_table(label: str) -> str:
    """A fresh table name."""
    name = f"{label}_{uuid.uuid4().hex}"
    _TABLES.append(name)
    return name


def release(spark: SparkSession) -> None:
    """Drop the tables and delete the folders that this process named so far: no result that reads them may be in use."""
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop()}")
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    while _FOLDERS:
        path = spark._jvm.org.apache.hadoop.fs.Path(_FOLDERS.pop())
        path.getFileSystem(hadoop).delete(path, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the scratch folder and read it back, cutting its lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

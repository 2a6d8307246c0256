"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession


# Folders made for applications without a shared one.
_TEMPORARY: dict[str, str] = {}


def build_session(app: str = "tidemark", master: str | None = None, **conf: object) -> SparkSession:
    """Session with the settings the library expects; ``conf`` overrides any of them.

    Values for partitions and memory are left to the cluster: only behaviour is set here.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        **{k: str(v) for k, v in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder from ``spark.checkpoint.dir``.

    A local session shares its disk with its executors and gets a temporary folder where none is set; on a
    cluster an unset folder is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        root = _TEMPORARY.setdefault(app, "") or tempfile.mkdtemp(prefix="tidemark-")
        _TEMPORARY[app] = root
    return root.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stable(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the row placement stays fixed and survives lost executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))
    return df.checkpoint()


def has_rows_stored(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists and holds more than job markers."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(folder):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(folder))


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, none if it does not exist. One listing, no files read."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(folder):
        return []
    return [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def _located(spark: SparkSession, uri: str):
    """The path of a file as ``_metadata.file_path`` names it, and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def remove_file(spark: SparkSession, uri: str) -> None:
    path, fs = _located(spark, uri)
    fs.delete(path, False)


def move_file(spark: SparkSession, uri: str, folder: str, inside: str) -> None:
    """Renames a file to ``inside``, an encoded path below ``folder``; its folders are made."""
    path, fs = _located(spark, uri)
    target = spark._jvm.org.apache.hadoop.fs.Path(folder, unquote(inside))
    fs.mkdirs(target.getParent())
    if not fs.rename(path, target):
        raise OSError(f"could not move {uri}")

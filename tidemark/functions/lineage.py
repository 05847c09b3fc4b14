"""Cut the lineage of an iterative job in the folder the cluster shares."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_local: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors reach. Only a session in a single process without the setting (a test) gets a
    temporary folder, which goes with the process; on a cluster the setting is required."""
    folder = spark.conf.get(SETTING, None)
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError(f"set {SETTING} to a folder that all executors share")
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="run-"))
            atexit.register(shutil.rmtree, _local[0], ignore_errors=True)
        folder = _local[0]
    return folder.rstrip("/")


def scratch(spark: SparkSession) -> str:
    """New, empty place in the shared folder for a written intermediate table."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def numbered_folders(spark: SparkSession, root: str, name: str) -> list[tuple[int, str]]:
    """(n, path) of the folders ``name=n`` under ``root``."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    paths = [str(s.getPath()) for s in fs.listStatus(target)] if fs.exists(target) else []
    return [(int(p.rsplit("=", 1)[1]), p) for p in paths if p.rsplit("/", 1)[1].startswith(f"{name}=")]


def remove(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def bytes_of(df: DataFrame) -> int:
    """Size on disk of the files that a frame reads, each counted once."""
    names = df.inputFiles()
    if not names:
        raise ValueError("the frame reads no files, so their size is unknown")
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(n)) for n in set(names)]
    return sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of the frame."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()

"""Cutting lineage with tables in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else one of our own, in local mode only."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="clipfold-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/clipfold/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path within the folder that ``clear`` deletes."""
    return f"{_folder(spark)}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    p, fs = file_system(spark, path)
    fs.delete(p, True)


def clear(spark: SparkSession) -> None:
    """Delete the tables this application has cut. Results that still read them must have been written before."""
    delete(spark, _folder(spark))


_open: list[list[str]] = []


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Tables cut inside are deleted at the end; what reads them must have been written by then."""
    mine: list[str] = []
    _open.append(mine)
    try:
        yield
    finally:
        _open.remove(mine)
        for path in mine:
            delete(spark, path)


def cut_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``cut``, with the path of the table."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    if _open:
        _open[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later stages restart from the files, so a lost executor costs no recomputation of what came before. The table is
    columnar and compressed, so a later step reads only the columns it needs.
    """
    return cut_at(df, name)[0]

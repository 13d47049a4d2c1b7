"""Shared-folder helpers built on Hadoop's file system API, so any store Spark reads works."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Whole messages are written with this codec: two thirds of the bytes that Spark's default makes of them.
TEXT_CODEC = {"compression": "zstd"}

def _locate(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _locate(spark, path)
    return fs.exists(where)


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, where = _locate(spark, path)
    return fs.getFileStatus(where).isDirectory()


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing where there is none."""
    fs, where = _locate(spark, path)
    return [entry.getPath().getName() for entry in fs.listStatus(where)] if fs.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _locate(spark, path)
    stream = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, in one step: it is written beside its place and then renamed. Fails where the place is taken, so
    of two writers one wins and neither is lost from sight. Needs a store that renames in one step."""
    fs, where = _locate(spark, path)
    _, beside = _locate(spark, f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}")
    stream = fs.create(beside, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    jvm = spark.sparkContext._jvm
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(where).toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    try:
        files.rename(beside, where, spark.sparkContext._gateway.new_array(rename, 0))
    except Exception:
        fs.delete(beside, False)
        raise


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _locate(spark, path)
    fs.delete(where, True)


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared folder; a local one is made only for a local master without it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="textpulse-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path nobody has used; Spark creates it on first write."""
    return f"{scratch_root(spark)}/textpulse/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, path: str, **options: str) -> DataFrame:
    """Write once, read many: cuts lineage, survives lost executors, and later readers
    fetch only the columns they use, with exact sizes for Spark's join choice."""
    df.write.mode("errorifexists").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Shared folders: where intermediate tables go so that they outlive executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder the cluster names in ``spark.checkpoint.dir``; without that setting, one below the
    session's warehouse folder, which every executor reaches as well."""
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/intermediate").rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path (not created), in one folder per application so that it is easy to clear."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def write_through(df: DataFrame, label: str) -> DataFrame:
    """Store ``df`` once as Parquet and read it back: cuts the lineage, survives lost executors."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme and host of the file system that Spark takes it to be on."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(hadoop_path).toString()


def uri_of(spark: SparkSession, path: str) -> str:
    """The qualified path as a URI, with blanks and the like escaped."""
    return spark._jvm.org.apache.hadoop.fs.Path(qualified(spark, path)).toUri().toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def list_files(spark: SparkSession, path: str) -> list[str]:
    """The file itself, or the visible files directly below a folder, in the order of their
    paths as Spark spells them in ``_metadata.file_path``."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop_path):
        raise ValueError(f"File not found: {path}")
    if fs.getFileStatus(hadoop_path).isFile():
        return [path]
    found = [status.getPath() for status in fs.listStatus(hadoop_path) if status.isFile()]
    names = sorted((p.toUri().toString(), p.getName()) for p in found)
    return [f"{path.rstrip('/')}/{name}" for _, name in names if not name.startswith((".", "_"))]


def file_states(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, length, time of change in ms) of a file, or of all visible files in a folder and below, in order."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    status = fs.getFileStatus(hadoop_path)
    if status.isFile():
        return [(status.getPath().toString(), status.getLen(), status.getModificationTime())]
    found = []
    for below in fs.listStatus(hadoop_path):
        if not below.getPath().getName().startswith((".", "_")):
            found += file_states(spark, below.getPath().toString())
    return sorted(found)


def head_of_file(spark: SparkSession, path: str, size: int = 1 << 20) -> str:
    """The first ``size`` bytes of a file as text, however long its lines are."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).open(hadoop_path)
    try:
        return bytes(stream.readNBytes(size)).decode("utf-8", "ignore")
    finally:
        stream.close()


def whole_file(spark: SparkSession, path: str) -> str:
    """A small file, such as a manifest, as text."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, replaced if it is there."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop_path, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def date_files(spark: SparkSession, path: str, first: int, step: int = 1000) -> None:
    """Give the files of a folder rising times (ms) in the order of their names, in which a stream then takes them."""
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for i, file in enumerate(list_files(spark, path)):
        fs.setTimes(spark._jvm.org.apache.hadoop.fs.Path(file), first + i * step, -1)

"""SHA-1 of data files against the manifest. A mismatch is reported, never fatal."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

SMALL_FILE = 64 * 1024 * 1024  # up to this size a file's content fits a row
READ_SIZE = 8 * 1024 * 1024


def file_digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, length, sha1``. Small files are hashed in SQL; larger ones are read in
    pieces, one task per file, because a hash runs through a file from front to back."""
    listed = spark.read.format("binaryFile").load(paths)
    small = listed.filter(F.col("length") <= SMALL_FILE).select("path", "length", F.sha1("content").alias("sha1"))

    def read_through(batches):
        from pyarrow import fs

        for batch in batches:
            digests = []
            for path in batch["path"]:
                filesystem, inner = fs.FileSystem.from_uri(path)
                digest = hashlib.sha1()
                with filesystem.open_input_stream(inner) as stream:
                    while piece := stream.read(READ_SIZE):
                        digest.update(piece)
                digests.append(digest.hexdigest())
            yield batch.assign(sha1=digests)

    large = (
        listed.filter(F.col("length") > SMALL_FILE)
        .select("path", "length")
        .mapInPandas(read_through, "path string, length bigint, sha1 string")
    )
    return small.unionByName(large)


def integrity_report(spark: SparkSession, expected: Mapping[str, tuple[list[str], str | None]]) -> DataFrame:
    """``dataset, files, expected, sha1, status`` for datasets given as name -> (files, SHA-1).

    Status is ``ok``, ``mismatch``, ``missing_hash`` or ``too_many_files``; only a dataset
    with one file and a hash is read.
    """
    rows = [(name, len(files), files[0], sha1) for name, (files, sha1) in expected.items()]
    wanted = spark.createDataFrame(rows, "dataset string, files int, _file string, expected string")
    checked = [files[0] for files, sha1 in expected.values() if sha1 is not None and len(files) == 1]
    if checked:
        digests = file_digests(spark, checked).select(_bare(F.col("path")).alias("_path"), "sha1")
    else:
        digests = spark.createDataFrame([], "_path string, sha1 string")
    status = (
        F.when(F.col("expected").isNull(), "missing_hash")
        .when(F.col("files") != 1, "too_many_files")
        .when(F.col("sha1").eqNullSafe(F.col("expected")), "ok")
        .otherwise("mismatch")
    )
    joined = wanted.withColumn("_path", _bare(F.col("_file"))).join(digests, "_path", "left")
    return joined.select("dataset", "files", "expected", "sha1", status.alias("status"))


def _bare(path):
    """A path without ``file:`` and repeated slashes, as Spark and users spell it differently."""
    return F.regexp_replace(path, "^file:/*", "/")

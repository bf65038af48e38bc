"""Commit marks: one small JSON file a version, put in place by a rename that never replaces."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another run committed first."""


def hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def numbers(spark: SparkSession, root: str) -> list[int]:
    """The committed versions below ``root``."""
    fs, marks = file_system(spark, root), hadoop_path(spark, f"{root}/marks")
    if not fs.exists(marks):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(marks)]
    return sorted(int(n) for n in names if n.isdigit())


def load(spark: SparkSession, root: str, number: int) -> dict:
    stream = file_system(spark, root).open(hadoop_path(spark, f"{root}/marks/{number}"))
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def put(spark: SparkSession, root: str, number: int, content: dict) -> None:
    """Commit version ``number``; of several runs that try, one succeeds and the others raise ``Conflict``."""
    fs, jvm = file_system(spark, root), spark.sparkContext._jvm
    fs.mkdirs(hadoop_path(spark, f"{root}/marks"))
    tmp, mark = (fs.makeQualified(hadoop_path(spark, f"{root}/marks/{name}")) for name in (f"_{uuid.uuid4().hex}", number))
    out = fs.create(tmp, False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(mark.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(tmp, mark, options)
    except Exception as e:
        fs.delete(tmp, False)
        if fs.exists(mark):
            raise Conflict(f"version {number} of {root} was committed by another run") from e
        raise

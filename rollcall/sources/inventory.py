"""File inventory.

Two scans give the same columns (pasta, arquivo, tamanho, data_criacao):

* ``file_inventory(spark, path)``: Spark's ``binaryFile`` source with
  recursive lookup; only ``path``, ``length`` and ``modificationTime`` are
  read (``content`` is pruned from the scan).  Like every Hadoop file source
  it skips names starting with ``.`` or ``_``.
* ``file_inventory(spark, path, hidden=True)`` and ``inventory_errors``: the
  Python data source ``rollcall_filetree``, which lists hidden entries too
  and turns a folder that cannot be listed into an error row instead of
  failing the job.  The driver lists folders breadth-first (metadata only)
  until there are several per wanted partition; deeper sub-trees are walked
  in tasks, and a listed folder with many files is split into hash parts,
  so neither a deep sub-tree nor one huge flat folder becomes one task.
"""

from __future__ import annotations

import datetime as _dt
import math
import os
import sys
import zlib

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from rollcall.functions.scalars import folder_of, mtime_date, name_of, to_mb

TREE_SCHEMA = "pasta string, arquivo string, tamanho double, mtime timestamp, error string"
MAX_EXPAND_DEPTH = 3
FILES_PER_PART = 20_000


class _TreePartition(InputPartition):
    def __init__(self, items):
        super().__init__(items)
        # (kind, path, part, parts): "walk" a sub-tree, "list" one folder level
        # (only the files whose name hashes to ``part`` of ``parts``), "stat" one file
        self.items = items


def _stat_row(folder: str, name: str):
    st = os.stat(os.path.join(folder, name))
    return (folder, name, st.st_size / 1024 / 1024,
            _dt.datetime.fromtimestamp(st.st_mtime, tz=_dt.timezone.utc), None)


def _error(folder: str, exc: Exception):
    return (folder, None, None, None, f"{type(exc).__name__}: {exc}")


def _mine(name: str, part: int, parts: int) -> bool:
    return parts == 1 or zlib.crc32(name.encode("utf-8", "surrogateescape")) % parts == part


def _scan_folder(folder: str, recurse: bool, part: int = 0, parts: int = 1):
    """Rows of one folder's files (its ``part`` share); sub-folders walked when ``recurse``.

    A folder whose listing raises, and a file whose stat raises, yields one
    error row and costs nothing else, so the rows don't depend on how folders
    are dealt out.
    """
    pending = [folder]
    while pending:
        current = pending.pop()
        try:
            for entry in sorted(os.listdir(current)):
                full = os.path.join(current, entry)
                if os.path.isdir(full):
                    if recurse:
                        pending.append(full)
                    continue
                if _mine(entry, part, parts):
                    try:
                        yield _stat_row(current, entry)
                    except OSError as exc:
                        yield _error(current, exc)
        except Exception as exc:  # noqa: BLE001 - every failure becomes an error row
            yield _error(current, exc)


class _TreeReader(DataSourceReader):
    def __init__(self, options):
        self.root = os.path.abspath(options["path"])
        self.target = int(options.get("partitions", "16"))
        self.files_per_part = int(options.get("filesPerPart", str(FILES_PER_PART)))

    def partitions(self):
        """Plan work items on the driver (folder metadata only).

        Folders are listed breadth-first until there are several folders per
        wanted partition or the depth limit; deeper sub-trees are walked in
        tasks.  A listed folder with many files is split into hash parts, so
        one huge folder's file stats spread over several tasks.
        """
        root = self.root
        if not os.path.isdir(root):
            return [_TreePartition([("stat", root, 0, 1)])]
        items, level, depth = [], [root], 0
        while level:
            deeper = []
            for folder in level:
                try:
                    entries = os.listdir(folder)
                except Exception:  # noqa: BLE001 - the task reports it as an error row
                    items.append(("list", folder, 0, 1))
                    continue
                subs = [os.path.join(folder, e) for e in sorted(entries)
                        if os.path.isdir(os.path.join(folder, e))]
                parts = max(1, math.ceil((len(entries) - len(subs)) / self.files_per_part))
                items.extend(("list", folder, k, parts) for k in range(parts))
                deeper.extend(subs)
            depth += 1
            if len(deeper) >= 4 * self.target or depth >= MAX_EXPAND_DEPTH:
                items.extend(("walk", f, 0, 1) for f in deeper)
                break
            level = deeper
        n = max(1, min(self.target, len(items)))
        return [_TreePartition(items[i::n]) for i in range(n)]

    def read(self, partition):
        for kind, path, part, parts in partition.items:
            if kind == "stat":
                try:
                    yield _stat_row(os.path.dirname(path), os.path.basename(path))
                except Exception as exc:  # noqa: BLE001
                    yield _error(os.path.dirname(path), exc)
            else:
                yield from _scan_folder(path, kind == "walk", part, parts)


class FileTreeSource(DataSource):
    """``spark.read.format("rollcall_filetree").load(folder)``: files and listing errors."""

    @classmethod
    def name(cls):
        return "rollcall_filetree"

    def schema(self):
        return TREE_SCHEMA

    def reader(self, schema):
        return _TreeReader(self.options)


def _tree(spark: SparkSession, path: str, partitions: int | None = None,
          files_per_part: int = FILES_PER_PART) -> DataFrame:
    # ship this module's code with the source, so Python workers need no install
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(FileTreeSource)
    n = partitions or max(2, spark.sparkContext.defaultParallelism * 2)
    return (spark.read.format("rollcall_filetree").option("partitions", str(n))
            .option("filesPerPart", str(files_per_part)).load(path))


def file_inventory(spark: SparkSession, path: str, hidden: bool = False,
                   files_per_part: int = FILES_PER_PART) -> DataFrame:
    """(pasta, arquivo, tamanho MB, data_criacao) for every file below ``path``."""
    if hidden:
        t = _tree(spark, path, files_per_part=files_per_part)
        return t.where(F.col("error").isNull()).select(
            "pasta", "arquivo", "tamanho", mtime_date(F.col("mtime")).alias("data_criacao"))
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
             .select("path", "length", "modificationTime"))
    return files.select(
        folder_of(F.col("path")).alias("pasta"),
        name_of(F.col("path")).alias("arquivo"),
        to_mb(F.col("length")).alias("tamanho"),
        mtime_date(F.col("modificationTime")).alias("data_criacao"),
    )


def inventory_of(rows: DataFrame, path: str, size: F.Column) -> DataFrame:
    """S7 + T8 + T10 over a table of paths and byte sizes: (pasta, arquivo, tamanho in MB)."""
    return rows.select(folder_of(F.col(path)).alias("pasta"), name_of(F.col(path)).alias("arquivo"), to_mb(size).alias("tamanho"))


def inventory_errors(spark: SparkSession, path: str) -> DataFrame:
    """Folders whose listing raised: (pasta, error)."""
    errors = _tree(spark, path).where(F.col("error").isNotNull())
    # a folder split into hash parts may fail in several of them: keep one row per folder
    return errors.groupBy("pasta").agg(F.min("error").alias("error"))


def inventory_count(inventory: DataFrame) -> DataFrame:
    """A3: number of files found."""
    return inventory.agg(F.count(F.lit(1)).alias("files"))

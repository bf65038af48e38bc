"""Stored tables with keys (K4, K5, K6, K10): buckets of keys, of which a batch rewrites only its own.

Layout below ``root``:

* ``data/part=<attempt>/bucket=<b>/``: rows of the keys that hash into bucket b, written by one attempt.
* ``marks/<n>``: version n, one JSON line: schema, keys, bucket count, and for every bucket the
  attempts whose files hold it.  Files that no mark names don't exist for readers.

A batch of rows touches the buckets of its keys (at most the bucket count of them, listed on the
driver).  ``upsert`` reads those buckets only, drops the keys that come again by an anti-join (the
batch's keys are broadcast where their size allows, so the stored rows stay where they are read),
and writes the buckets anew beside the old files.  ``insert_ignore`` and ``append`` rewrite nothing:
their new rows are further files of the buckets.

**Keys are constraints.**  Repeated and null keys are counted by the same job that writes
(``observe``).  A version that breaks them is not committed: ``KeyViolation``.
**Versions are compare-and-set.**  A mark is put in place by a rename that doesn't replace, so of two
runs that started from version n only one becomes n + 1; the other raises ``Conflict`` and may be
run again.  A run cut off leaves files that nobody reads; ``vacuum`` deletes them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.operators.upsert import pick_row
from rollcall.schemas import KEYS, TABLES, conform, empty
from rollcall.session import bounded_broadcast
from rollcall.sources import marks
from rollcall.sources.marks import Conflict, file_system, hadoop_path

__all__ = ["Conflict", "KeyViolation", "Version", "append", "create", "create_all", "insert_ignore", "latest", "read", "replace", "upsert", "vacuum"]

BUCKET, NTH = "__bucket", "__nth"


class KeyViolation(ValueError):
    """A table's keys would repeat or be null."""


@dataclass
class Version:
    number: int
    schema: T.StructType
    keys: list[str]
    buckets: int
    parts: dict[int, list[str]]  # bucket -> attempts


def latest(spark: SparkSession, root: str) -> Version | None:
    """The newest committed version, or None."""
    done = marks.numbers(spark, root)
    if not done:
        return None
    d = marks.load(spark, root, done[-1])
    return Version(done[-1], T.StructType.fromJson(d["schema"]), d["keys"], d["buckets"], {int(b): p for b, p in d["parts"].items()})


def _commit(spark: SparkSession, root: str, v: Version) -> None:
    """Make ``v`` the newest version, if no other run has made one of its number."""
    marks.put(spark, root, v.number, {"schema": v.schema.jsonValue(), "keys": v.keys, "buckets": v.buckets, "parts": v.parts})


def create(spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], buckets: int | None = None) -> Version:
    """An empty table.  An existing one is an error (``Conflict``)."""
    v = Version(0, schema, list(keys), buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), {})
    _commit(spark, root.rstrip("/"), v)
    return v


def create_all(spark: SparkSession, root: str, buckets: int | None = None) -> None:
    """All tables of the data model below ``root``."""
    for name, schema in TABLES.items():
        create(spark, f"{root.rstrip('/')}/{name}", schema, KEYS[name], buckets)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def read(spark: SparkSession, root: str, version: Version | None = None, only: Sequence[int] | None = None) -> DataFrame:
    """The table at its newest (or the given) version; ``only``: some buckets, whose files alone are read."""
    root = root.rstrip("/")
    v = version or latest(spark, root)
    if v is None:
        raise ValueError(f"no table at {root}")
    paths = [f"{root}/data/part={p}/bucket={b}" for b, parts in sorted(v.parts.items()) if only is None or b in set(only) for p in parts]
    if not paths:
        return empty(spark, v.schema)
    return spark.read.schema(v.schema).parquet(*paths)


def _touched(batch: DataFrame) -> list[int]:
    return sorted(r[0] for r in batch.select(BUCKET).distinct().collect())  # at most the bucket count


def _write(spark: SparkSession, root: str, v: Version, stored: DataFrame | None, batch: DataFrame, strict: bool) -> tuple[str, list[int]]:
    """Write ``batch`` (with its bucket) and the ``stored`` rows of its buckets; returns the attempt and the buckets that have files.

    ``strict``: the batch's keys mustn't repeat.  Two rows of a key are told apart before they travel,
    so a key that fills a third of the batch is cut down to two rows a task.
    """
    attempt = uuid.uuid4().hex[:16]
    if strict:
        w = Window.partitionBy(BUCKET, *v.keys).orderBy(F.lit(0))
        batch = batch.withColumn(NTH, F.row_number().over(w)).where(F.col(NTH) <= 2)
    else:
        batch = batch.withColumn(NTH, F.lit(1))
    batch = batch.repartition(BUCKET)
    rows = batch
    if stored is not None:
        rows = stored.withColumn(BUCKET, bucket_of(v.keys, v.buckets)).withColumn(NTH, F.lit(1)).unionByName(batch)
    null_key = F.lit(False)
    for k in v.keys:
        null_key = null_key | F.col(k).isNull()
    seen = Observation()
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum((F.col(NTH) > 1).cast("long")).alias("repeated"),
                        F.sum((null_key & (F.col(NTH) == 1)).cast("long")).alias("null"), F.collect_set(BUCKET).alias("buckets"))
    rows.drop(NTH).withColumnRenamed(BUCKET, "bucket").write.partitionBy("bucket").parquet(f"{root}/data/part={attempt}")
    found = seen.get
    if found["repeated"] or found["null"]:
        file_system(spark, root).delete(hadoop_path(spark, f"{root}/data/part={attempt}"), True)
        raise KeyViolation(f"{root}: {found['repeated'] or 0} keys repeated, {found['null'] or 0} null, in {v.keys}")
    return attempt, sorted(found["buckets"])


def _batch(spark: SparkSession, root: str, batch: DataFrame, v: Version) -> DataFrame:
    return conform(batch, v.schema).withColumn(BUCKET, bucket_of(v.keys, v.buckets))


def _of(spark: SparkSession, root: str) -> Version:
    v = latest(spark, root)
    if v is None:
        raise ValueError(f"no table at {root}")
    return v


def _same_key(keys: Sequence[str], a: str, b: str) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return same


def surviving(spark: SparkSession, root: str, v: Version, new: DataFrame, touched: Sequence[int]) -> DataFrame:
    """The stored rows of the touched buckets whose keys aren't among the ``new`` rows'."""
    keys = bounded_broadcast(new.select(*v.keys))
    return read(spark, root, v, touched).alias("s").join(keys.alias("k"), _same_key(v.keys, "s", "k"), "left_anti")


def upsert(spark: SparkSession, root: str, batch: DataFrame, order: Sequence[str]) -> Version:
    """K5: the batch's last row of each key by ``order`` replaces the whole stored row; columns not given become null."""
    root = root.rstrip("/")
    v = _of(spark, root)
    last = pick_row(batch, v.keys, order, last=True)
    new = _batch(spark, root, last, v).checkpoint()
    touched = _touched(new)
    if not touched:
        return v
    attempt, held = _write(spark, root, v, surviving(spark, root, v, new, touched), new, strict=False)
    parts = {b: p for b, p in v.parts.items() if b not in touched} | {b: [attempt] for b in held}
    done = Version(v.number + 1, v.schema, v.keys, v.buckets, parts)
    _commit(spark, root, done)
    return done


def insert_ignore(spark: SparkSession, root: str, batch: DataFrame, order: Sequence[str]) -> Version:
    """K6: the batch's first row of each key that the table lacks is added; stored rows stay, and their files."""
    root = root.rstrip("/")
    v = _of(spark, root)
    first = _batch(spark, root, pick_row(batch, v.keys, order, last=False), v).checkpoint()
    stored = read(spark, root, v, _touched(first)).select(*v.keys)
    keys = bounded_broadcast(first.select(*v.keys))
    known = stored.alias("s").join(keys.alias("k"), _same_key(v.keys, "s", "k"), "left_semi")
    return _add(spark, root, v, first.alias("f").join(known.alias("k"), _same_key(v.keys, "f", "k"), "left_anti"), strict=False)


def append(spark: SparkSession, root: str, batch: DataFrame) -> Version:
    """Rows of new keys; a key that repeats, is null or is stored already refuses the whole batch."""
    root = root.rstrip("/")
    v = _of(spark, root)
    new = _batch(spark, root, batch, v).checkpoint()
    keys = bounded_broadcast(new.select(*v.keys).distinct())
    stored = read(spark, root, v, _touched(new)).select(*v.keys)
    if known := stored.alias("s").join(keys.alias("k"), _same_key(v.keys, "s", "k"), "left_semi").count():
        raise KeyViolation(f"{root}: {known} keys are stored already")
    return _add(spark, root, v, new, strict=True)


def _add(spark: SparkSession, root: str, v: Version, new: DataFrame, strict: bool) -> Version:
    attempt, held = _write(spark, root, v, None, new, strict)
    done = Version(v.number + 1, v.schema, v.keys, v.buckets, v.parts | {b: [*v.parts.get(b, []), attempt] for b in held})
    _commit(spark, root, done)
    return done


def replace(spark: SparkSession, root: str, batch: DataFrame) -> Version:
    """K4: the batch in place of all rows; repeated and null keys refuse it."""
    root = root.rstrip("/")
    v = _of(spark, root)
    attempt, held = _write(spark, root, v, None, _batch(spark, root, batch, v), strict=True)
    done = Version(v.number + 1, v.schema, v.keys, v.buckets, {b: [attempt] for b in held})
    _commit(spark, root, done)
    return done


def vacuum(spark: SparkSession, root: str) -> int:
    """Delete files that the newest version doesn't name; not to be run beside writers or readers of older versions."""
    root = root.rstrip("/")
    v, fs = _of(spark, root), file_system(spark, root)
    live, gone = {p for parts in v.parts.values() for p in parts}, 0
    if not fs.exists(hadoop_path(spark, f"{root}/data")):
        return 0
    for status in fs.listStatus(hadoop_path(spark, f"{root}/data")):
        if status.getPath().getName().removeprefix("part=") not in live:
            fs.delete(status.getPath(), True)
            gone += 1
    return gone

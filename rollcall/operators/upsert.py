"""Keyed table maintenance (K4 replace, K5 insert-or-replace, K6 insert-or-ignore).

Parquet tables take no MERGE or primary key, so an upsert is one pass: tag
target and batch, union them, and keep one row per key.  Each side is read
and shuffled once.  Null keys are one key like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions.scalars import free_name


def pick_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool = True) -> DataFrame:
    """One row per key, the last (or first) by ``order``; ties are broken arbitrarily.

    ``row_number() = 1`` is planned with a ``WindowGroupLimit`` before the
    shuffle, which leaves one row per key and task: a key holding a third of
    all rows is reduced there.
    """
    by = [F.col(c).desc_nulls_last() if last else F.col(c).asc_nulls_first() for c in order]
    w = Window.partitionBy(*keys).orderBy(*by)
    nth = free_name("_nth", df)
    return df.withColumn(nth, F.row_number().over(w)).where(F.col(nth) == 1).drop(nth)


def replace_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """K4: drop the old table and load ``df`` in its place; returns the new table."""
    w = df.write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def _one_pass(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool) -> DataFrame:
    fresh, names = free_name("_new", target), [free_name(f"_by{i}", target) for i in range(len(order))]
    new = batch.select(*[c for c in batch.columns if c in target.columns], F.lit(True).alias(fresh),
                       *[F.col(c).alias(n) for c, n in zip(order, names, strict=True)])
    old = target.withColumn(fresh, F.lit(False))
    both = old.unionByName(new, allowMissingColumns=True)
    kept = pick_row(both, keys, [fresh, *names], last=last)
    return kept.select(*[F.col(f.name).cast(f.dataType) for f in target.schema.fields])


def upsert_replace(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                   order: Sequence[str]) -> DataFrame:
    """K5: INSERT OR REPLACE; later batch rows win and replace the whole row.

    Columns the batch does not supply become null; batch columns unknown to
    the target are dropped.
    """
    return _one_pass(target, batch, keys, order, last=True)


def insert_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                  order: Sequence[str]) -> DataFrame:
    """K6: INSERT OR IGNORE; existing rows stay, the first batch row per new key wins."""
    return _one_pass(target, batch, keys, order, last=False)

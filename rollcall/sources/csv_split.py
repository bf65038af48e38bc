"""S5 on large files: quoted CSV read in byte ranges, line breaks within quotes included.

A line break ends a record only outside quotes, so where a range of a file starts within a quoted
value can't be told from the range itself.  Two passes settle it:

1. every range counts its quotes (a doubled quote counts twice, and changes nothing).  Whether a
   range starts within quotes is the parity of all quotes before it in its file, a running sum over
   one row a range;
2. every range puts its lines together to records, knowing how it starts.  What it holds of a
   record begun before it, or not ended in it, goes out as a piece; pieces (at most two a range) are
   joined in the order of their ranges.

Ranges are those of Spark's own text scan, whose lines carry the range they were read in; a line
belongs to the range that it starts in.  A task reads many ranges one after the other where they are
small, so that tasks, and what they send each other, are counted by the bytes of the files, not by ranges.
Quotes must be written as the exports write them: a value that holds one is quoted, and doubles it.
A file whose quotes don't close is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.session import DEFAULT_BROADCAST_ROWS, checkpoint_root

# About the bytes that a task reads, in as many ranges as they make; smaller inputs still give every core tasks.
TASK_BYTES = 32 << 20
TASKS_PER_CORE = 4

COMPLETE, HEAD, TAIL = 0, 1, 2
_OUT = "kind int, file string, start long, first boolean, closes boolean, record string"


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, start, value): every line, and the range it was read in; a task has whole ranges, one after the other."""
    size = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).agg(F.sum("length")).first()[0] or 0
    tasks = max(-(-size // TASK_BYTES), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    text = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(paths)
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    return lines.coalesce(tasks)


def range_states(lines: DataFrame, quote: str) -> DataFrame:
    """(file, start, quoted): whether each range starts within quotes."""
    quotes = F.sum(F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))).alias("n")
    ranges = lines.groupBy("file", "start").agg(quotes)
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return ranges.select("file", "start", (F.coalesce(F.sum("n").over(before), F.lit(0)) % 2 == 1).alias("quoted"))


class _Range:
    """The records of one range, line by line."""

    def __init__(self, file: str, start: int, quoted: bool):
        self.file, self.start = file, start
        self.head = quoted  # still in the record begun before the range
        self.first = start == 0  # nothing of the file was read yet
        self.open, self.inside = [], quoted

    def _piece(self, kind: int, closes: bool) -> tuple:
        record = "\n".join(self.open)
        first = self.first and bool(record.strip("\r"))
        self.first &= not first
        self.open = []
        return kind, self.file, self.start, first, closes, record

    def take(self, values: list[str], odd: list[bool]) -> Iterator[tuple]:
        for value, flips in zip(values, odd, strict=True):
            self.inside ^= flips
            self.open.append(value)
            if not self.inside:
                yield self._piece(HEAD if self.head else COMPLETE, True)
                self.head = False

    def end(self) -> Iterator[tuple]:
        if self.open:
            yield self._piece(HEAD if self.head else TAIL, False)


def _assemble(quote: str):
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int32(), pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["kind", "file", "start", "first", "closes", "record"])

    def run(batches):
        current = None
        for batch in batches:
            files, starts, values, quoted = (batch.column(i) for i in range(4))
            odd = pc.equal(pc.bit_wise_and(pc.count_substring(values, quote), 1), 1).to_pylist()
            files, starts, values, quoted = files.to_pylist(), starts.to_pylist(), values.to_pylist(), quoted.to_pylist()
            out, at = [], 0
            while at < len(values):
                end = at
                while end < len(values) and starts[end] == starts[at] and files[end] == files[at]:
                    end += 1
                if current is None or (current.file, current.start) != (files[at], starts[at]):
                    if current:
                        out += current.end()
                    current = _Range(files[at], starts[at], quoted[at])
                out += current.take(values[at:end], odd[at:end])
                at = end
            yield batch_of(out)
        if current:
            yield batch_of(list(current.end()))

    return run


def split_records(spark: SparkSession, paths: list[str], quote: str = '"', max_broadcast: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """(file, first, record): the records of CSV files, ``first`` those that begin their file; blank ones are left out."""
    checkpoint_root(spark)
    lines = _lines(spark, paths)
    states = range_states(lines, quote).checkpoint()
    if states.count() <= max_broadcast:  # the lines stay where they were read, in their order
        stated = lines.join(F.broadcast(states), ["file", "start"], "left")
    else:
        at = lines.withColumn("at", F.monotonically_increasing_id()).join(states, ["file", "start"], "left")
        stated = at.repartition("file", "start").sortWithinPartitions("file", "start", "at")
    # Spark may divide files otherwise when it scans again, if the cluster changed meanwhile
    known = F.coalesce("quoted", F.raise_error(F.lit("the ranges of the files changed between two scans; run it again")).cast("boolean"))
    pieces = stated.select("file", "start", "value", known.alias("quoted")).mapInArrow(_assemble(quote), _OUT)
    whole = pieces.where(F.col("kind") == COMPLETE).select("file", "first", "record")
    # a record begins at a piece that its range didn't end, and takes in the pieces that begin the next ranges
    parts = pieces.where(F.col("kind") != COMPLETE)
    order = Window.partitionBy("file").orderBy("start", "kind")
    parts = parts.withColumn("group", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    joined = parts.groupBy("file", "group").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "record"))).alias("p"), F.max("closes").alias("closes"), F.max("first").alias("first"))
    record = F.when(F.col("closes"), F.array_join("p.record", "\n")).otherwise(F.raise_error(F.concat(F.lit("quotes that don't close in "), "file")).cast("string"))
    out = whole.unionByName(joined.select("file", "first", record.alias("record")))
    record = F.when(F.col("record").endswith("\r"), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return out.select("file", "first", record.alias("record")).where("record <> ''")


def read_split_csv(spark: SparkSession, paths: list[str], columns: list[str], sep: str, quote: str, index: bool = False) -> DataFrame:
    """The rows of UTF-8 CSV files as text ``columns``, with ``file``.

    Every file's header must name the columns (after the first one's name, where that is an ``index``).
    """
    records = split_records(spark, paths, quote)
    names = [f"c{i}" for i in range(len(columns))]
    options = {"sep": sep, "quote": quote, "escape": quote, "multiLine": "true", "mode": "FAILFAST",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    row = F.from_csv(F.ltrim("record", F.lit("\ufeff")), ", ".join(f"{n} string" for n in names), options)
    wrong = F.lit(False)
    for n, c in list(zip(names, columns, strict=True))[index:]:
        wrong = wrong | ~F.col(f"r.{n}").eqNullSafe(F.lit(c))
    refuse = F.raise_error(F.concat(F.lit("another header in "), "file")).cast("boolean")
    rows = records.select("file", "first", row.alias("r")).where(F.when(F.col("first"), F.when(wrong, refuse).otherwise(False)).otherwise(True))
    return rows.select("file", *[F.col(f"r.{n}").alias(c) for n, c in zip(names, columns, strict=True)])

"""Semicolon CSV export and import.

Export format (fixed values): separator ``;``, header, double quotes doubled
inside quoted values, floats written with a decimal comma, UTF-8 (Latin-1
for the file inventory), values kept whole (no trimming of surrounding white
space).  An empty text and a null are both written empty and both read back
as null.

Spark has no decimal-comma option, so DOUBLE / FLOAT columns are formatted
as text with the dot replaced, and parsed back the same way.  Every read
takes a fixed schema; nothing is inferred.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions.times import stamp
from rollcall.session import bounded_broadcast, checkpoint_root
from rollcall.sources.csv_split import read_split_csv

# Fixed values of the export format.
SEP = ";"
QUOTE = '"'
TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TS_ZONED_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSSxxx"
DATE_FORMAT = "yyyy-MM-dd"
INDEX_COL = "_index"
LATIN1_OUTSIDE = "[^\\x{00}-\\x{FF}]"
JSON_TS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
JSON_TS_NTZ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def plain_float(c: F.Column) -> F.Column:
    """Shortest decimal text of a float with a comma: plain from 1e-4 up to 1e16, else as ``1,5e-07``."""
    s = F.lower(c.cast("string"))
    sign = F.when(s.startswith("-"), "-").otherwise("")
    s = F.regexp_replace(s, "^-", "")
    exponent = F.coalesce(F.regexp_extract(s, r"e(-?\d+)$", 1).try_cast("int"), F.lit(0))
    mantissa = F.regexp_replace(F.regexp_replace(s, r"e.*$", ""), r"\.0$", "")
    digits = F.replace(mantissa, F.lit("."), F.lit(""))
    shown = F.length(digits) - 1  # digits after the first
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    whole = F.concat(F.rpad(digits, exponent + 1, "0"), F.lit(".0"))
    broken = F.concat(F.substring(digits, F.lit(1), exponent + 1), F.lit("."), F.substring(digits, exponent + 2, F.length(digits)))
    power = F.concat(mantissa, F.when(exponent < 0, "e-").otherwise("e+"), F.lpad(F.abs(exponent).cast("string"), F.greatest(F.lit(2), F.length(F.abs(exponent).cast("string"))), "0"))
    plain = F.when(exponent < 0, small).when(exponent >= shown, whole).otherwise(broken)
    text = F.when(s == "infinity", "inf").when(~s.contains("e"), s).when((exponent < -4) | (exponent >= 16), power).otherwise(plain)
    # Java turns to an exponent below 1e-3 and from 1e7 on only
    return F.when(F.isnan(c), F.lit(None).cast("string")).otherwise(F.replace(F.concat(sign, text), F.lit("."), F.lit(",")))


def _decimal_comma(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = plain_float(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def with_row_index(df: DataFrame, order: Sequence[str], per: str | None = None) -> DataFrame:
    """Opt-in leading row index 0..n-1 by ``order`` without a single-task window.

    Range-partition and sort, take each partition's row count (one row per
    partition), turn the counts into offsets, and add the offset to the
    position inside the partition.  The sorted rows are checkpointed first
    so ids are stable.  ``per``: start again at 0 for each value of that column.
    """
    checkpoint_root(df.sparkSession)
    order = [per, *[c for c in order if c != per]] if per else list(order)
    # a unique tie-breaker lets equal sort keys spread over several range partitions,
    # so one value holding a third of the rows does not become one task
    tagged = df.withColumn("_tie", F.monotonically_increasing_id())
    sorted_df = tagged.orderBy(*order, "_tie").withColumn("_pid", F.spark_partition_id()).withColumn(
        "_mid", F.monotonically_increasing_id()).checkpoint(eager=True)
    counts = sorted_df.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    offsets = bounded_broadcast(offsets)
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    out = (sorted_df.join(offsets, "_pid")
           .select((F.col("_off") + pos).alias(INDEX_COL), *df.columns))
    if not per:
        return out
    first = bounded_broadcast(out.groupBy(F.col(per).alias("_per")).agg(F.min(INDEX_COL).alias("_first")))
    out = out.join(first, F.col(per).eqNullSafe(F.col("_per")))
    return out.select((F.col(INDEX_COL) - F.col("_first")).alias(INDEX_COL), *df.columns)


def _writer(df: DataFrame, encoding: str):
    # Spark trims values on write by default; the export keeps them whole
    return (df.write.option("sep", SEP).option("header", True).option("quote", QUOTE)
            .option("escape", QUOTE).option("emptyValue", "").option("nullValue", "")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("encoding", encoding).option("timestampNTZFormat", TS_FORMAT)
            .option("timestampFormat", TS_ZONED_FORMAT)
            .option("dateFormat", DATE_FORMAT))


def write_export_csv(df: DataFrame, path: str, index_order: Sequence[str] | None = None,
                     mode: str = "errorifexists", folder_per: str | None = None) -> None:
    """K1: ``;`` CSV, decimal comma, UTF-8; a leading row index only when asked.

    ``folder_per``: the rows of each value of that column go to a
    ``<column>=<value>`` folder (a snapshot each, as the exports are), as
    several part files where there are many; the index starts at 0 in each,
    and part files follow it.
    """
    if index_order:
        df = with_row_index(df, index_order, folder_per)
    if folder_per:
        write_folders(df, path, folder_per, mode)
    else:
        _writer(_decimal_comma(df), "UTF-8").mode(mode).csv(path)


def write_folders(df: DataFrame, path: str, folder_per: str, mode: str = "errorifexists") -> None:
    """The folders of ``write_export_csv``, of rows that already have their index (or need none)."""
    keys = [folder_per, *([INDEX_COL] if INDEX_COL in df.columns else [])]
    out = _decimal_comma(df).repartitionByRange(*keys).sortWithinPartitions(*keys)
    _writer(out, "UTF-8").mode(mode).partitionBy(folder_per).csv(path)


def stamped(folder: str, name: str, ts: _dt.datetime) -> str:
    """The path of a stamped output, ``folder/name_YYYY-MM-DD HHMMSS``."""
    return f"{folder.rstrip('/')}/{name}_{stamp(ts)}"


def check_latin1(df: DataFrame) -> None:
    """Raise when a text value has a character Latin-1 cannot encode.

    Spark's writer would silently write ``?`` instead.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return
    bad = F.lit(False)
    for t in texts:
        bad = bad | F.coalesce(F.col(t).rlike(LATIN1_OUTSIDE), F.lit(False))
    hit = df.where(bad).limit(1).count()
    if hit:
        raise ValueError("value not encodable in latin-1")


def write_inventory_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """K2 + O1: inventory CSV, Latin-1, no index, ordered by folder and name.

    The global sort range-partitions the rows; part files follow the order.
    """
    check_latin1(df)
    _writer(_decimal_comma(df.orderBy("pasta", "arquivo")), "ISO-8859-1").mode(mode).csv(path)


def write_raw(df: DataFrame, path: str, mode: str = "append") -> None:
    """K3: untouched nested records before projection (bronze layer), as JSON.

    Timestamps keep microseconds: Spark's default JSON format writes milliseconds.
    """
    (df.write.mode(mode).option("timestampFormat", JSON_TS)
     .option("timestampNTZFormat", JSON_TS_NTZ).json(path))


# Files from this size on are read in ranges.  A smaller one is a task of its own in any case.
SPLIT_BYTES = 32 << 20


def _largest(spark: SparkSession, paths: list[str]) -> int:
    sizes = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).agg(F.max("length")).first()[0]
    return sizes or 0


def in_file_order(df: DataFrame, file_col: str, position: str = "position") -> DataFrame:
    """``df`` as read from files (``file_col``: which), with each row's place among all rows: files by name, rows as they stand.

    Rows are numbered within their file, which a task reads in order, and shifted by the rows of the files before it.
    """
    checkpoint_root(df.sparkSession)
    read = df.withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    files = read.groupBy(F.col(file_col).alias("_file")).agg(F.count(F.lit(1)).alias("_n"))
    # one row a file
    offsets = bounded_broadcast(files.select("_file", (F.sum("_n").over(Window.orderBy("_file")) - F.col("_n")).alias("_off")))
    within = F.row_number().over(Window.partitionBy(file_col).orderBy("_at")) - 1
    placed = read.withColumn("_within", within).join(offsets, F.col(file_col) == F.col("_file"))
    return placed.select(*df.columns, (F.col("_off") + F.col("_within")).alias(position))


def read_records(spark: SparkSession, path: str, column: str = "record") -> DataFrame:
    """K3: JSON records of any fields as a VARIANT, none of them lost or retyped."""
    return spark.read.option("singleVariantColumn", column).json(path)


def write_records(df: DataFrame, path: str, mode: str = "append") -> None:
    """K3: dump untouched records (VARIANT columns among others), before any projection."""
    df.write.mode(mode).parquet(path)


def project_records(df: DataFrame, schema: T.StructType, column: str = "record") -> DataFrame:
    """The declared fields of dumped records: one that a record lacks is null, and its further fields stay in the dump."""
    fields = [F.try_variant_get(column, f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    return df.select(*fields)


def read_export_csv(spark: SparkSession, path, schema: T.StructType,
                    has_index: bool | None = False, source_col: str | None = None,
                    encoding: str = "UTF-8", keep_index: bool = False, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Read ``;`` CSV written by K1 (or by the studied code) into ``schema``.

    ``path`` is a path or a list of paths.  Columns are taken by the names in
    the header; a name missing from it, or unknown to ``schema``, is an error.
    All files of one call share the first one's header (checked by Spark where
    there is no unnamed index column).  The leading index column is dropped, or
    kept as ``INDEX_COL``; with ``has_index=None`` there is one where the header's first
    name is empty, or its name by ``INDEX_COL``.  ``source_col`` adds the file each row came from
    (decoded path).  Text is read as text, then cast: decimal commas become
    dots for DOUBLE / FLOAT, and casts fail loudly (ANSI) on bad text.

    Where a file is as large as ``split_bytes`` (and UTF-8), all are read in byte ranges by many tasks
    (``csv_split``), else each file is one task.
    """
    def reader():
        return (spark.read.option("sep", SEP).option("header", True)
                .option("quote", QUOTE).option("escape", QUOTE).option("multiLine", True)
                .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
                .option("encoding", encoding).option("mode", "FAILFAST")
                .option("recursiveFileLookup", True))  # part folders name no columns

    paths = [path] if isinstance(path, str) else list(path)
    header = reader().csv(paths[:1]).columns
    if has_index is None:
        # an unnamed first column comes as _c0
        has_index = bool(header) and header[0] in ("_c0", INDEX_COL) and header[0] not in schema.fieldNames()
    if not header:  # nothing was written
        header = [INDEX_COL] * has_index + schema.fieldNames()
    names = header[1:] if has_index else header
    if sorted(names) != sorted(schema.fieldNames()):
        raise ValueError(f"columns {names} where {schema.fieldNames()} are expected")
    columns = ([INDEX_COL] if has_index else []) + names
    if encoding == "UTF-8" and _largest(spark, paths) >= split_bytes:
        raw, source = read_split_csv(spark, paths, columns, SEP, QUOTE, has_index), F.col("file")
    else:
        fields = [T.StructField(n, T.StringType(), True) for n in columns]
        raw, source = reader().schema(T.StructType(fields)).option("enforceSchema", has_index).csv(paths), F.col("_metadata.file_path")
    cols = [F.col(INDEX_COL)] if keep_index else []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.replace(c, F.lit(","), F.lit("."))
        if not isinstance(f.dataType, T.StringType):
            c = c.cast(f.dataType)
        cols.append(c.alias(f.name))
    if source_col:
        cols.append(F.url_decode(F.replace(source, F.lit("+"), F.lit("%2B"))).alias(source_col))
    return raw.select(*cols)

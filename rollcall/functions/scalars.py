"""Small scalar helpers (T5-T10) as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def free_name(name: str, *frames: DataFrame) -> str:
    """``name``, lengthened until no column of the frames has it."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def to_pk(c: Column) -> Column:
    """T5: text or number id to BIGINT; unparsable text gives null (see ``split_rejects``)."""
    return F.trim(c.cast("string")).try_cast("bigint")


def pk_of(df: DataFrame, name: str) -> Column:
    """``name`` of ``df`` as a BIGINT id: integral columns are cast, only text goes through ``to_pk``."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.LongType):
        return F.col(name)
    if isinstance(dtype, (T.IntegerType, T.ShortType, T.ByteType)):
        return F.col(name).cast("bigint")
    return to_pk(F.col(name))


def strict_pk(df: DataFrame, name: str) -> Column:
    """``name`` as a BIGINT id; text that is no id ends the query instead of becoming null."""
    parsed = pk_of(df, name)
    if not isinstance(df.schema[name].dataType, (T.StringType, T.DoubleType, T.FloatType, T.DecimalType)):
        return parsed
    shown = F.concat(F.lit(f"not an id in {name}: "), F.col(name).cast("string"))
    return F.coalesce(parsed, F.when(F.col(name).isNotNull(), F.raise_error(shown)).cast("bigint"))


def split_ids(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """T5: rows whose id ``name`` parses (as BIGINT, or is null), and the rejected rows as they are."""
    return split_rejects(df, name, pk_of(df, name))


def to_ts(c: Column) -> Column:
    """T5: text to TIMESTAMP_NTZ; unparsable text gives null."""
    return c.cast("string").try_cast("timestamp_ntz")


def split_rejects(df: DataFrame, name: str, parsed: Column) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``name`` parses (value replaced) and rows that do not (kept as is)."""
    new = free_name("_parsed", df)
    tagged = df.withColumn(new, parsed)
    bad = tagged.where(F.col(name).isNotNull() & F.col(new).isNull()).drop(new)
    good = (tagged.where(F.col(name).isNull() | F.col(new).isNotNull())
            .withColumn(name, F.col(new)).drop(new))
    return good, bad


def greeting_name(full_name: Column, username: Column) -> Column:
    """Full name, or the username when it is null."""
    return F.coalesce(full_name, username)


def render(template: str, name: Column) -> Column:
    """``template`` with its single ``{}`` replaced by ``name``."""
    parts = template.split("{}")
    if len(parts) != 2:
        raise ValueError("template must hold exactly one {} placeholder")
    return F.concat(F.lit(parts[0]), name, F.lit(parts[1]))


def to_mb(length: Column) -> Column:
    """Bytes to MB as DOUBLE (``/1024/1024``)."""
    return length.cast("double") / F.lit(1048576.0)


def mtime_date(ts: Column) -> Column:
    """Modification time to a date in the session zone."""
    return F.to_date(ts)


def strip_scheme(path: Column) -> Column:
    return F.regexp_replace(path, r"^file:(//)?", "")


def folder_of(path: Column) -> Column:
    """Folder part of a path (everything before the last ``/``)."""
    return F.regexp_extract(strip_scheme(path), r"^(.*)/([^/]*)$", 1)


def name_of(path: Column) -> Column:
    """File-name part of a path."""
    return F.regexp_extract(strip_scheme(path), r"^(.*)/([^/]*)$", 2)

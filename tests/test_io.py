"""K1/S5 CSV round trip, K2 Latin-1 check, S6 catalogue, S7/S8 inventory (FIXTURES.md §2)."""

import datetime as dt
import glob
import os
import tempfile

import pytest
from pyspark.sql import types as T

from rollcall.session import scratch_path
from rollcall.sources import (
    file_inventory, inventory_errors, list_snapshot_files, read_export_csv, write_export_csv,
    write_inventory_csv,
)

SCHEMA = T.StructType([
    T.StructField("pk", T.LongType()), T.StructField("txt", T.StringType()),
    T.StructField("x", T.DoubleType()), T.StructField("ok", T.BooleanType()),
    T.StructField("ts", T.TimestampNTZType()), T.StructField("d", T.DateType()),
])

ROWS = [
    (1, "a;b", 1.5, True, dt.datetime(2024, 1, 1, 0, 0, 7, 179575), dt.date(2024, 1, 1)),
    (2, 'say "hi"', -2.25, False, dt.datetime(2024, 1, 2), dt.date(2024, 1, 2)),
    (3, "two\nlines ç", 1e7, None, None, None),
    (4, "", None, True, dt.datetime(2024, 1, 3, 5), dt.date(2024, 1, 3)),
    (5, None, 0.1, False, dt.datetime(2024, 1, 4), dt.date(2024, 1, 4)),
]


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def _text(path):
    return "".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(f"{_local(path)}/part-*")))


def test_csv_round_trip(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    path = scratch_path(spark, "t-csv")
    write_export_csv(df, path)
    text = _text(path)
    assert "1,5" in text and '"say ""hi"""' in text and "pk;txt;x;ok;ts;d" in text
    back = {r.pk: tuple(r) for r in read_export_csv(spark, path, SCHEMA).collect()}
    for row in ROWS:
        expect = list(row)
        if expect[1] == "":
            expect[1] = None  # an empty text returns as null
        assert back[row[0]] == tuple(expect)


def test_csv_with_index(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    path = scratch_path(spark, "t-csv-idx")
    write_export_csv(df, path, index_order=["pk"])
    assert _text(path).startswith("_index;pk;")
    back = spark.read.option("sep", ";").option("header", True).option("multiLine", True).csv(path)
    assert sorted((int(r._index), int(r.pk)) for r in back.collect()) == [(i, i + 1) for i in range(5)]
    assert read_export_csv(spark, path, SCHEMA, has_index=True).count() == 5


def test_latin1_export(spark):
    inv = spark.createDataFrame([("/p", "b é", 1.0, dt.date(2024, 1, 1)), ("/p", "a", 0.5, None)],
                                "pasta string, arquivo string, tamanho double, data_criacao date")
    path = scratch_path(spark, "t-inv")
    write_inventory_csv(inv, path)
    raw = b"".join(open(p, "rb").read() for p in sorted(glob.glob(f"{_local(path)}/part-*")))
    text = raw.decode("latin-1")
    assert "b é;1,0" in text and text.index(";a;") < text.index(";b é;")
    bad = spark.createDataFrame([("/p", "x → y", 1.0, None)], inv.schema)
    with pytest.raises(ValueError):
        write_inventory_csv(bad, scratch_path(spark, "t-inv-bad"))


@pytest.fixture(scope="module")
def tree():
    root = tempfile.mkdtemp(prefix="rollcall-tree-")
    os.makedirs(f"{root}/sub/deeper")
    os.makedirs(f"{root}/empty")
    os.makedirs(f"{root}/_x")
    os.makedirs(f"{root}/broken")
    with open(f"{root}/top.txt", "wb") as fh:
        fh.write(b"x" * 1048576)
    for p in ("sub/deeper/nested.csv", "sub/name é.txt", ".h", "_x/in_x.txt", "broken/ok.txt"):
        with open(f"{root}/{p}", "w") as fh:
            fh.write("data")
    os.symlink(f"{root}/missing-target", f"{root}/broken/dangling")
    return root


def test_inventory_binary_file(spark, tree):
    got = {(r.pasta, r.arquivo): r for r in file_inventory(spark, tree).collect()}
    assert got[(tree, "top.txt")].tamanho == 1.0
    assert (f"{tree}/sub", "name é.txt") in got
    assert (f"{tree}/sub/deeper", "nested.csv") in got
    assert (tree, ".h") not in got and (f"{tree}/_x", "in_x.txt") not in got  # Hadoop sources skip them
    assert got[(tree, "top.txt")].data_criacao == dt.date.today()


def test_inventory_data_source_lists_hidden_and_errors(spark, tree):
    got = {(r.pasta, r.arquivo) for r in file_inventory(spark, tree, hidden=True).collect()}
    assert {(tree, ".h"), (f"{tree}/_x", "in_x.txt"), (tree, "top.txt"),
            (f"{tree}/sub", "name é.txt"), (f"{tree}/sub/deeper", "nested.csv"), (f"{tree}/broken", "ok.txt")} <= got
    one_each = {(r.pasta, r.arquivo) for r in file_inventory(spark, tree, hidden=True, files_per_part=1).collect()}
    assert one_each == got  # however the folder is dealt out
    assert not any(p == f"{tree}/empty" for p, _ in got)
    errs = inventory_errors(spark, tree).collect()
    assert [e.pasta for e in errs] == [f"{tree}/broken"] and "FileNotFoundError" in errs[0].error


def test_snapshot_catalogue_from_files(spark):
    folder = tempfile.mkdtemp(prefix="rollcall-snaps-")
    for name in ("df_followers_2024-01-02 101500.csv", "df_followers_2024-01-01 090000.csv",
                 "df_followings_2024-01-01 090000.csv"):
        open(f"{folder}/{name}", "w").write(";pk;username;full_name\n")
    cat = list_snapshot_files(spark, folder).collect()
    assert [r.arquivo for r in cat] == ["df_followers_2024-01-01 090000.csv",
                                         "df_followers_2024-01-02 101500.csv"]
    assert cat[1].snap_ts == dt.datetime(2024, 1, 2, 10, 15) and cat[1].snap_date == dt.date(2024, 1, 2)


def test_data_source_splits_a_huge_flat_folder(spark):
    root = tempfile.mkdtemp(prefix="rollcall-flat-")
    os.makedirs(f"{root}/big")
    for i in range(300):
        open(f"{root}/big/f{i:03d}.txt", "w").write("x")
    open(f"{root}/top.txt", "w").write("y")
    df = file_inventory(spark, root, hidden=True, files_per_part=50)
    assert df.rdd.getNumPartitions() > 1
    rows = df.collect()
    names = sorted(r.arquivo for r in rows if r.pasta == f"{root}/big")
    assert names == [f"f{i:03d}.txt" for i in range(300)]  # each file once
    assert [r.arquivo for r in rows if r.pasta == root] == ["top.txt"]


def test_csv_compatible_with_pandas_both_ways(spark):
    import pandas as pd

    folder = tempfile.mkdtemp(prefix="rollcall-pandas-")
    pdf = pd.DataFrame({"pk": [1, 2, 3], "txt": ["a;b", 'say "hi"', "two\nlines ç"],
                        "x": [1.5, -2.25, float("nan")]})
    pdf.to_csv(f"{folder}/export.csv", sep=";", decimal=",", encoding="utf-8")  # with the row index
    schema = T.StructType([T.StructField("pk", T.LongType()), T.StructField("txt", T.StringType()),
                           T.StructField("x", T.DoubleType())])
    got = sorted(tuple(r) for r in read_export_csv(spark, f"{folder}/export.csv", schema, has_index=True)
                 .collect())
    assert got == [(1, "a;b", 1.5), (2, 'say "hi"', -2.25), (3, "two\nlines ç", None)]

    path = scratch_path(spark, "t-to-pandas")
    write_export_csv(spark.createDataFrame([(1, "a;b", 1.5), (2, "two\nlines ç", None)], schema), path)
    part = sorted(glob.glob(f"{_local(path)}/part-*.csv"))
    frames = [pd.read_csv(p, sep=";", decimal=",") for p in part]
    back = pd.concat([f for f in frames if len(f)]).sort_values("pk")
    assert back["txt"].tolist() == ["a;b", "two\nlines ç"] and back["x"].tolist()[0] == 1.5


def test_snapshot_names_from_files_and_partition_folders(spark):
    from rollcall.sources.catalog import snapshot_catalog
    paths = spark.createDataFrame([
        ("file:/x/CSVs/df_followers_2024-01-02 101500.csv",),
        ("file:/x/out/snapshot=df_followers_2024-01-03 080000/part-00000-abc.csv",),
        ("file:/x/CSVs/df_followings_2024-01-02 101500.csv",),
        ("file:/x/CSVs/notes.txt",),
    ], "path string")
    got = [(r.arquivo, r.snap_ts, r.snap_date) for r in snapshot_catalog(paths).collect()]
    assert got == [("df_followers_2024-01-02 101500.csv", dt.datetime(2024, 1, 2, 10, 15), dt.date(2024, 1, 2)),
                   ("df_followers_2024-01-03 080000", dt.datetime(2024, 1, 3, 8, 0), dt.date(2024, 1, 3))]


from hypothesis import HealthCheck, example, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

TEXT = st.text(alphabet=st.sampled_from(list('ab ;",.çé') + ["\n", "\t", " ", "→"]), max_size=12)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@example([(" a", None), ("a ", 1.5), (" ", None), ("\ta\n", -0.25), (" ; ", 1e-7), ("D Ávila  Zé ", None)])
@given(st.lists(st.tuples(TEXT, st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False,
                                                                  width=64))), min_size=1, max_size=6))
def test_csv_round_trip_property(spark, rows):
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("t", T.StringType()),
                           T.StructField("x", T.DoubleType())])
    data = [(i, t, x) for i, (t, x) in enumerate(rows)]
    path = scratch_path(spark, "t-csv-prop")
    write_export_csv(spark.createDataFrame(data, schema), path)
    back = {r.i: (r.t, r.x) for r in read_export_csv(spark, path, schema).collect()}
    for i, t, x in data:
        assert back[i] == ((t if t != "" else None), x)  # an empty text returns as null


def test_csv_zoned_timestamps_keep_microseconds(spark):
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("z", T.TimestampType())])
    t = dt.datetime(2024, 1, 1, 0, 30, 7, 123456, tzinfo=dt.timezone.utc)
    path = scratch_path(spark, "t-csv-tz")
    write_export_csv(spark.createDataFrame([(1, t)], schema), path)
    assert "2024-01-01 00:30:07.123456+00:00" in _text(path)
    back = read_export_csv(spark, path, schema).collect()[0].z
    assert back.replace(tzinfo=dt.timezone.utc) == t or back == t.replace(tzinfo=None)

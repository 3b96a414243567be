"""Tables that change all their folders in one step."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.sources import layout, snapshots
from isobar.sources.gold import read_gold, write_gold
from isobar.sources.silver import mirror, read_silver, write_silver
from samples import rows, silver

SCHEMA = T.StructType([T.StructField("x", T.LongType()), T.StructField("day", T.IntegerType()), T.StructField("place", T.StringType())])
KEYS = ["day", "place"]


def table(spark, cells):
    return spark.createDataFrame([(x, day, place) for (day, place), x in cells.items()], SCHEMA)


def put(spark, root, cells, **how):
    version = snapshots.write_version(table(spark, cells), root, KEYS)
    assert version.rows == len(cells)
    snapshots.publish(spark, root, version.name, KEYS, **how)
    return version.name


def state(spark, root, only=None):
    return {(r.day, r.place): r.x for r in snapshots.read(spark, root, SCHEMA, KEYS, only).collect()}


ODD = ["St. John's", "A:B", "50%", "a=b", "x+y z", "ß", None]


def test_publishing_replaces_just_the_written_folders(spark, folder):
    first = {(d, p): 10 * d for d in (1, 2) for p in ODD}
    put(spark, folder("t"), first)
    assert state(spark, folder("t")) == first
    second = {(2, "A:B"): 7, (2, None): 8, (3, "new"): 9}
    put(spark, folder("t"), second)
    assert state(spark, folder("t")) == first | second
    assert state(spark, folder("t"), F.col("day") == "2") == {k: v for k, v in (first | second).items() if k[0] == 2}
    assert state(spark, folder("t"), F.lit(False)) == {}
    put(spark, folder("t"), {(5, "a"): 1}, whole=True)
    assert state(spark, folder("t")) == {(5, "a"): 1}
    put(spark, folder("t"), {}, whole=True)
    assert state(spark, folder("t")) == {} and snapshots.keys_of(spark, folder("t")) == KEYS


def test_a_reader_sees_one_whole_state(spark, folder, monkeypatch):
    first, second = {(d, "a"): 1 for d in range(5)}, {(d, "a"): 2 for d in range(1, 4)}
    put(spark, folder("t"), first)
    reader = snapshots.read(spark, folder("t"), SCHEMA, KEYS)
    version = snapshots.write_version(table(spark, second), folder("t"), KEYS).name
    assert state(spark, folder("t")) == first  # written, not published

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "create_file", stop)
        with pytest.raises(KeyboardInterrupt):
            snapshots.publish(spark, folder("t"), version, KEYS)
    assert state(spark, folder("t")) == first  # the state's table is there, its name is not
    snapshots.publish(spark, folder("t"), version, KEYS)
    assert state(spark, folder("t")) == first | second
    assert {(r.day, r.place): r.x for r in reader.collect()} == first  # begun before, still whole


def test_calls_do_not_grow_with_the_folders(spark, folder, monkeypatch):
    calls = []
    plain = layout._file_system
    counts = []
    for n in (10, 2000):
        root = folder(f"t{n}")
        put(spark, root, {(0, "a"): 1})
        monkeypatch.setattr(layout, "_file_system", lambda *a: calls.append(a) or plain(*a))
        days = spark.range(n).select("id", F.col("id").cast("int").alias("day"), F.lit("a").alias("place")).toDF("x", "day", "place")
        version = snapshots.write_version(days.coalesce(4), root, KEYS).name
        calls.clear()
        snapshots.publish(spark, root, version, KEYS)
        counts.append(len(calls))
        calls.clear()
        assert snapshots.folders(spark, root, KEYS) == ([f"{root}/{version}"], [])
        counts.append(len(calls))
        monkeypatch.setattr(layout, "_file_system", plain)
    assert counts[:2] == counts[2:] and counts[0] < 12
    assert snapshots.folders(spark, root, KEYS, F.col("day").isin("7", "9"))[0] == [f"{root}/{version}/day=7", f"{root}/{version}/day=9"]


def test_folders_of_the_plain_layout_are_kept(spark, folder):
    first = {(d, p): d for d in (1, 2) for p in ("a", "b")}
    table(spark, first).write.partitionBy(*KEYS).parquet(folder("t"))
    assert not snapshots.has_snapshots(spark, folder("t"))
    put(spark, folder("t"), {(2, "b"): 5})
    assert state(spark, folder("t")) == first | {(2, "b"): 5}
    put(spark, folder("t"), {(1, "a"): 6, (9, "c"): 7})
    assert state(spark, folder("t")) == first | {(2, "b"): 5, (1, "a"): 6, (9, "c"): 7}


def test_versions_without_a_folder_in_use_are_deleted(spark, folder):
    names = [put(spark, folder("t"), {(1, "a"): i, (2, "a"): i} if i else {(1, "a"): 0, (3, "a"): 0}) for i in range(5)]
    left = {n for n in os.listdir(folder("t")) if n.startswith("version=")}
    assert left == {names[0], names[3], names[4]}  # the first holds day 3, the last but one is the state before
    assert state(spark, folder("t")) == {(1, "a"): 4, (2, "a"): 4, (3, "a"): 0}
    assert len(os.listdir(os.path.join(folder("t"), "_snapshots"))) < 3 * (2 * snapshots.KEPT)


def test_two_writers_of_one_number_are_told(spark, folder, monkeypatch):
    put(spark, folder("t"), {(1, "a"): 1})
    make = snapshots.create_file

    def twice(spark_, path):
        number, table_ = path.rsplit("/", 1)[1].split("-")
        make(spark_, path.replace(table_, "0" * 12))
        make(spark_, path)

    monkeypatch.setattr(snapshots, "create_file", twice)
    with pytest.raises(RuntimeError, match="Another writer"):
        put(spark, folder("t"), {(1, "a"): 2})


TWO_DAYS = [
    ("2026-01-25T00:00:00", -1.0, 50, 0.0, 1.0, "Boston"), ("2026-01-25T01:00:00", None, 51, 0.1, 2.0, "Boston"),
    ("2026-01-26T00:00:00", 0.0, None, None, None, "New York"),
]


def test_gold_that_fails_leaves_the_state_and_no_version(spark, folder, monkeypatch):
    from isobar.operators.curate import curate
    from isobar.sources import gold

    write_gold(silver(spark, TWO_DAYS), folder("gold"))
    before, names = rows(read_gold(spark, folder("gold"))), sorted(os.listdir(folder("gold")))
    with monkeypatch.context() as patch:
        patch.setattr(gold, "curate", lambda s: curate(s).limit(1))
        with pytest.raises(ValueError, match="silver 3, gold 1"):
            write_gold(silver(spark, TWO_DAYS), folder("gold"))
    assert rows(read_gold(spark, folder("gold"))) == before and sorted(os.listdir(folder("gold"))) == names
    write_gold(silver(spark, TWO_DAYS[2:]), folder("gold"))
    assert rows(read_gold(spark, folder("gold"))) == before


def test_presence_is_a_matter_of_names(spark, folder):
    """Files of the second root that could not be read are not opened, and their partitions are left alone."""
    write_silver(silver(spark, TWO_DAYS), folder("copy"))
    for above, _, files in os.walk(folder("copy")):
        for name in files:
            if name.endswith(".parquet"):
                with open(os.path.join(above, name), "wb") as file:
                    file.write(b"not a table")
    more = silver(spark, [*TWO_DAYS, ("2026-01-26T03:00:00", 4.0, 1, 1.0, 1.0, "Salem")])
    mirror(more, folder("copy"), check_exists=True)
    found = read_silver(spark, folder("copy"), ["2026-01-26"], ["Salem"])
    assert rows(found, "temperature_2m") == [(4.0,)]
    listed = layout.leaf_folders(spark, [folder("copy")], ["source", "run_date", "location"])
    assert sorted(r.location for r in listed.collect()) == ["Boston", "New York", "Salem"]

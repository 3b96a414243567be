"""Thousands of small folders: written by tasks themselves, published and read without a step for each."""

import os

import pytest
from pyspark.sql import functions as F

from isobar.schemas import GOLD, GOLD_PARTITIONS
from isobar.operators.curate import curate
from isobar.sources import many_folders, snapshots
from isobar.sources.gold import read_gold, read_gold_by_path, write_gold
from isobar.sources.layout import read_parquet
from samples import rows, silver

DAY, NEXT = "2026-01-25", "2026-01-26"
ODD = [*[f"a{chr(c)}b" for c in range(1, 128)], "St. John's", "ß°", "x+y z", "run_date=5", "a%2Fb", "", None]


def gold(spark, names, days=(DAY, NEXT)):
    found = [(f"{day}T{i % 24:02}:00:00", i / 7 if i % 5 else None, i if i % 3 else None, 0.0, 1.5, name) for i, name in enumerate(names) for day in days]
    return silver(spark, found)


def leaves(root):
    return sorted({os.path.relpath(at, root) for at, _, files in os.walk(root) if "=" in at for f in files if f.endswith(".parquet") and not f.startswith(".")})


def files(root):
    return [f for at, _, names in os.walk(root) if "=" in at for f in names if f.endswith(".parquet")]


def test_folders_and_rows_are_those_of_sparks_writer(spark, folder):
    data = curate(gold(spark, ODD).unionByName(gold(spark, ODD[100:])))
    data.write.partitionBy(*GOLD_PARTITIONS).parquet(folder("plain"))
    assert many_folders.write(data, folder("many"), GOLD_PARTITIONS) == data.count()
    assert leaves(folder("many")) == leaves(folder("plain"))
    listed = many_folders.listed(spark, folder("many"))
    assert sorted({r.folder for r in listed.collect()}) == leaves(folder("plain"))
    assert listed.agg(F.sum("n_rows")).first()[0] == data.count()
    assert rows(read_parquet(spark, folder("many"), GOLD)) == rows(read_parquet(spark, folder("plain"), GOLD))
    assert many_folders.write(data.where("location = 'nowhere'"), folder("none"), GOLD_PARTITIONS) == 0


@pytest.mark.parametrize("most", [1, 50_000, 32 << 20])
def test_a_folder_of_many_rows(spark, folder, monkeypatch, most):
    monkeypatch.setattr(many_folders, "_ROW_GROUP_BYTES", most)
    data = spark.range(25_000).select("id", F.when(F.col("id") % 1000 == 0, F.col("id").cast("string")).otherwise("hot").alias("place"))
    assert many_folders.write(data.repartition(3), folder("t"), ["place"]) == 25_000
    assert len(files(folder("t"))) == 25 + 3
    assert rows(read_parquet(spark, folder("t"), data.schema)) == rows(data)


def test_a_task_run_again_replaces_its_files(spark, folder):
    data = spark.range(500).select("id", (F.col("id") % 50).cast("string").alias("place")).repartition(4, "place").sortWithinPartitions("place")
    for _ in range(2):
        data.mapInArrow(many_folders._files(folder("t"), ["place"], spark.version, "UTF-8"), "folder string, n_rows bigint").collect()
    assert len(files(folder("t"))) == 50
    assert rows(read_parquet(spark, folder("t"), data.schema)) == rows(data)


def test_names_that_the_jvm_cannot_write(spark, folder):
    """They are question marks there, as Spark's writer has them; two that become one are not one."""
    def write(*names):
        data = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id long, place string").coalesce(1)
        return data.mapInArrow(many_folders._files(folder("t"), ["place"], spark.version, "ANSI_X3.4-1968"), "folder string, n_rows bigint").count()

    assert write("a", "ß") == 2 and sorted(os.listdir(folder("t"))) == ["place=?", "place=a"]
    with pytest.raises(Exception, match="Two partitions of the name"):
        write("°", "ß")


def test_no_process_no_listing_and_no_task_for_a_few_folders(spark, folder, monkeypatch):
    """Before, each folder had files of check sums, made with processes of their own, publishing listed all of them five times, and a task read four."""
    names = [*ODD[:-2], *[f"place {i}" for i in range(400)]]
    monkeypatch.setattr(snapshots, "leaf_folders", None)
    assert write_gold(gold(spark, names), folder("gold")) == 2 * len(names)
    assert not [f for at, _, found in os.walk(folder("gold")) if "location=" in at for f in found if f.endswith(".crc")]
    by_path = read_gold_by_path(spark, folder("gold"))
    assert by_path.rdd.getNumPartitions() <= 16
    assert rows(by_path) == rows(read_gold(spark, folder("gold")))
    assert sorted(r.location for r in by_path.where(F.col("run_date") == DAY).collect()) == sorted(names)


def test_paths_of_plain_and_published_folders(spark, folder):
    """Folders from before there were snapshots, a version of many folders, one of few that replaces some of both, and one that nobody published."""
    curate(gold(spark, ["old", "older", None])).write.partitionBy(*GOLD_PARTITIONS).parquet(folder("gold"))
    assert rows(read_gold_by_path(spark, folder("gold"))) == rows(read_gold(spark, folder("gold")))
    write_gold(gold(spark, [f"place {i}" for i in range(600)] + ["old"], [DAY]), folder("gold"))
    write_gold(gold(spark, ["first", "place 7", "older"], [DAY]), folder("gold"))
    snapshots.write_version(curate(gold(spark, ["unseen"])), folder("gold"), GOLD_PARTITIONS, True)
    found = read_gold_by_path(spark, folder("gold"))
    assert rows(found) == rows(read_gold(spark, folder("gold")))
    days = {(str(r.run_date), r.location) for r in found.collect()}
    assert days == {(DAY, f"place {i}") for i in range(600)} | {(d, n) for d in (DAY, NEXT) for n in ("old", "older", None)} | {(DAY, "first")}
    assert found.count() == 607

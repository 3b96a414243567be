"""Layers whose folders are dates: a file holds many locations, and single locations are replaced."""

import os

import pytest
from pyspark.sql import functions as F

from isobar.plans import jobs
from isobar.sources.bronze import land_bronze, read_bronze
from isobar.sources.gold import read_gold, read_gold_by_path, write_gold
from isobar.sources.silver import mirror, read_silver, write_silver
from samples import COMPLETE, document, hours, rows, silver

DAY, NEXT = "2026-01-25", "2026-01-26"


def cells(spark, *found):
    """(day, location, temperature) as silver rows."""
    return silver(spark, [(f"{day}T0{at}:00:00", t, 50, 0.0, 1.0, place) for at, (day, place, t) in enumerate(found)])


def state(df, temperature="temperature_2m"):
    return rows(df, F.col("run_date").cast("string"), "location", temperature)


def files(root):
    return [f for _, _, names in os.walk(root) for f in names if f.endswith(".parquet")]


def bundle(spark, root, *documents):
    import json

    texts = [(d if isinstance(d, str) else json.dumps(d, indent=2), day, place) for day, place, d in documents]
    spark.createDataFrame(texts, "value string, run_date string, location string").coalesce(1).write.mode("overwrite").partitionBy("run_date").parquet(root)


def test_files_do_not_grow_with_the_locations(spark, folder):
    """Before, a thousand locations of one date were a thousand folders and files in each layer."""
    names = [f"place {i}" for i in range(1000)]
    bundle(spark, folder("landed"), *[(DAY, n, document(hours(f"{DAY}T12:00", temperature_2m=[1.5]))) for n in names])
    lookup = spark.createDataFrame([(n, 1.0, 2.0) for n in names], "location string, latitude double, longitude double")
    land_bronze(spark, folder("landed"), folder("bronze"), "s", lookup, grain="date", bundled=True)
    assert jobs.ingest(spark, folder("bronze"), folder("silver"), grain="date") == 1000
    assert jobs.curate_job(spark, folder("silver"), folder("gold"), grain="date") == 1000
    for layer in ("bronze", "silver", "gold"):
        assert len(files(folder(layer))) < 30
    assert rows(read_gold(spark, folder("gold"), [DAY]).select("location")) == sorted([(n,) for n in names], key=repr)


def test_many_folders_are_written_by_many_tasks(spark, folder):
    """Before, folders so small that they fit in one task by their bytes were all written by that one."""
    found = [(f"place {i}", float(i)) for i in range(520)]
    staged = silver(spark, [(f"{DAY}T12:00:00", t, 50, 0.0, 1.0, place) for place, t in found]).repartition(4)
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    assert write_gold(staged, folder("gold")) == 520
    assert len({name.split("-")[1] for name in files(folder("gold")) if name.startswith("part-")}) > 2
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == kept
    by_path = read_gold_by_path(spark, folder("gold")).select("location", "temp_celsius")
    assert rows(by_path) == sorted(found, key=repr)


def test_only_given_partitions_are_replaced(spark, folder):
    write_silver(cells(spark, (DAY, "a", 1.0), (DAY, "b", 2.0), (DAY, None, 3.0), (NEXT, "a", 4.0), (NEXT, "", 5.0)), folder("s"), grain="date")
    write_silver(cells(spark, (DAY, "a", 6.0), (NEXT, None, 7.0), ("2026-01-27", "c", 8.0)), folder("s"))
    expected = [(DAY, "a", 6.0), (DAY, "b", 2.0), (DAY, None, 3.0), (NEXT, "a", 4.0), (NEXT, None, 7.0), ("2026-01-27", "c", 8.0)]
    assert state(read_silver(spark, folder("s"))) == sorted(expected, key=repr)
    assert state(read_silver(spark, folder("s"), [DAY], ["b"], "stations")) == [(DAY, "b", 2.0)]
    assert read_silver(spark, folder("s"), None, None, "model").count() == read_silver(spark, folder("s"), []).count() == 0
    other = cells(spark, (DAY, "a", 9.0)).withColumn("source", F.lit("model"))
    write_silver(other, folder("s"))
    assert state(read_silver(spark, folder("s"), source="stations")) == sorted(expected, key=repr)
    with pytest.raises(ValueError, match="name one source"):
        jobs.curate_job(spark, folder("s"), folder("gold"), grain="date")
    for _ in range(2):
        assert jobs.curate_job(spark, folder("s"), folder("gold"), source="stations", grain="date") == 6
    jobs.curate_job(spark, folder("s"), folder("gold"), [DAY], ["a"], "model")
    found = state(read_gold(spark, folder("gold")), "temp_celsius")
    assert found == sorted([(DAY, "a", 9.0), *expected[1:]], key=repr)


def test_mirror_by_date(spark, folder):
    mirror(cells(spark, (DAY, "a", 1.0), (DAY, None, 2.0)), folder("copy"), grain="date")
    changed = cells(spark, (DAY, "a", 5.0), (DAY, None, 5.0), (DAY, "b", 5.0), (NEXT, "a", 5.0))
    mirror(changed, folder("copy"), check_exists=True)
    expected = [(DAY, "a", 1.0), (DAY, None, 5.0), (DAY, "b", 5.0), (NEXT, "a", 5.0)]  # one without a name counts as missing
    assert state(read_silver(spark, folder("copy"))) == sorted(expected, key=repr)
    mirror(changed, folder("copy"), check_exists=True)  # nothing else is left to copy
    assert state(read_silver(spark, folder("copy"))) == sorted(expected, key=repr)


def test_failed_jobs_leave_the_layer(spark, folder):
    with pytest.raises(ValueError, match="empty"):
        write_silver(silver(spark, []), folder("silver"), grain="date")
    assert not os.path.exists(folder("silver"))
    bundle(spark, folder("landed"), (DAY, "Boston", COMPLETE))
    land_bronze(spark, folder("landed"), folder("bronze"), "s", grain="date", bundled=True)
    jobs.ingest(spark, folder("bronze"), folder("silver"), grain="date")
    before, names = state(read_silver(spark, folder("silver"))), sorted(os.listdir(folder("silver")))
    bundle(spark, folder("landed"), (DAY, "Boston", document(hours(f"{DAY}T15:00", f"{DAY}T15:00"))))
    land_bronze(spark, folder("landed"), folder("bronze"), "s", bundled=True)
    with pytest.raises(ValueError, match="#location=Boston: duplicates: .*duplicates on natural key"):
        jobs.ingest(spark, folder("bronze"), folder("silver"))
    assert state(read_silver(spark, folder("silver"))) == before and sorted(os.listdir(folder("silver"))) == names
    bundle(spark, folder("landed"), (DAY, "Atlantis", COMPLETE))
    with pytest.raises(LookupError, match="Atlantis"):
        land_bronze(spark, folder("landed"), folder("bronze"), "s", bundled=True)


def test_landing_chosen_dates_and_locations(spark, folder):
    places = spark.createDataFrame([(n, 1.0, 2.0) for n in "ab"], "location string, latitude double, longitude double")
    docs = [(day, place, {**COMPLETE, "extra": 1}) for day in (DAY, NEXT) for place in "ab"]
    bundle(spark, folder("landed"), *docs)
    land_bronze(spark, folder("landed"), folder("bronze"), "s", places, [DAY], ["a"], grain="date", bundled=True)
    land_bronze(spark, folder("landed"), folder("bronze"), "s", places, [DAY], ["b"], bundled=True)
    found = read_bronze(spark, folder("bronze"), [DAY, "1999-01-01"], source="s")
    assert rows(found, "location", F.get_json_object("value", "$.extra"), F.get_json_object("value", "$.source")) == [("a", "1", "s"), ("b", "1", "s")]
    assert read_bronze(spark, folder("bronze"), ["1999-01-01"]).count() == 0


def test_a_layer_keeps_its_layout(spark, folder):
    write_silver(cells(spark, (DAY, "a", 1.0)), folder("by date"), grain="date")
    write_silver(cells(spark, (DAY, "a", 1.0)), folder("by location"))
    for name, other in (("by date", "location"), ("by location", "date")):
        with pytest.raises(ValueError, match="laid out by"):
            write_silver(cells(spark, (DAY, "a", 1.0)), folder(name), grain=other)
        write_gold(read_silver(spark, folder(name)), folder(f"gold {name}"), grain=name.split()[1])
    with pytest.raises(ValueError, match="laid out by date"):
        read_gold_by_path(spark, folder("gold by date"))
    jobs.curate_job(spark, folder("by date"), folder("gold by location"))
    assert read_gold_by_path(spark, folder("gold by location")).count() == 1

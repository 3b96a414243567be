"""Landing, ingesting, mirroring and curating folders."""

import os

import pytest
from pyspark.sql import functions as F

from isobar.operators.curate import curate
from isobar.plans import jobs
from isobar.sources.bronze import land_bronze, read_bronze
from isobar.sources.gold import read_gold, read_gold_by_path, write_gold
from isobar.sources.layout import partition_path
from isobar.sources.silver import mirror, read_silver, write_silver
from samples import COMPLETE, document, hours, land, rows, silver

DAY = "2026-01-25"


def lookup(spark, *names):
    return spark.createDataFrame([(n, 1.0, 2.0) for n in names], "location string, latitude double, longitude double")


def test_partition_path():
    assert partition_path("/tmp/bronze", "feed", "2026-02-10") == "/tmp/bronze/source=feed/run_date=2026-02-10"
    assert partition_path("/tmp/bronze/", "feed", "2026-02-10", "Boston").endswith("/location=Boston")


def test_known_location(spark):
    from isobar.sources.bronze import known_locations

    boston = known_locations(spark).where("location = 'Boston'").first()
    assert (boston["latitude"], boston["longitude"]) == (42.3601, -71.0589)


def test_landing_adds_metadata_and_keeps_every_field(spark, folder):
    land(folder("landed"), DAY, "Boston", {**COMPLETE, "extra": {"a": [1, 2]}}, indent=2)
    for _ in range(2):
        land_bronze(spark, folder("landed"), folder("bronze"), 'a "b"')
    docs = read_bronze(spark, folder("bronze"))
    parsed = docs.select(
        F.get_json_object("value", "$.source").alias("doc_source"),
        F.get_json_object("value", "$.extra.a[1]").alias("extra"),
        F.get_json_object("value", "$.ingestion_timestamp").cast("timestamp").alias("at"),
        "source", F.col("run_date").cast("string"), "location",
    ).collect()
    assert len(parsed) == 1
    assert tuple(parsed[0])[:2] == ('a "b"', "2") and parsed[0]["at"] is not None
    assert tuple(parsed[0])[3:] == ('a "b"', DAY, "Boston")


def test_landing_an_empty_object(spark, folder):
    land(folder("landed"), DAY, "Boston", "{ }")
    land_bronze(spark, folder("landed"), folder("bronze"), "s")
    assert read_bronze(spark, folder("bronze")).select(F.get_json_object("value", "$.source")).first()[0] == "s"


def test_unknown_location(spark, folder):
    land(folder("landed"), DAY, "Atlantis", COMPLETE)
    with pytest.raises(LookupError, match="Atlantis"):
        land_bronze(spark, folder("landed"), folder("bronze"), "s")


@pytest.mark.parametrize("read", [read_bronze, read_silver, read_gold])
def test_missing_layer(spark, folder, read):
    with pytest.raises(FileNotFoundError):
        read(spark, folder("nowhere"))


def test_no_silver_for_the_date(spark, folder):
    write_silver(silver(spark, TWO_DAYS), folder("silver"))
    with pytest.raises(ValueError, match="no silver rows"):
        jobs.curate_job(spark, folder("silver"), folder("gold"), ["1999-01-01"])


def test_ingest_many_documents(spark, folder):
    names = ["Boston", "New York", "7", "a+b"]
    for day in (DAY, "2026-01-26"):
        for name in names:
            land(folder("landed"), day, name, document(hours(f"{day}T12:00", f"{day}T13:00", temperature_2m=[1.5, None])))
    land_bronze(spark, folder("landed"), folder("bronze"), "s", lookup(spark, *names))
    assert jobs.ingest(spark, folder("bronze"), folder("silver")) == 16
    found = read_silver(spark, folder("silver"))
    assert rows(found.select("location").distinct()) == sorted([(n,) for n in names], key=repr)
    one = read_silver(spark, folder("silver"), [DAY], ["New York"], "s")
    assert rows(one, F.col("time").cast("string"), "temperature_2m") == [
        ("2026-01-25 12:00:00", 1.5), ("2026-01-25 13:00:00", None),
    ]
    assert read_silver(spark, folder("silver"), []).count() == 0
    write_gold(found, folder("gold"))
    by_path = read_gold_by_path(spark, folder("gold"))
    assert rows(by_path) == rows(read_gold(spark, folder("gold")))


def test_failed_ingest_commits_nothing(spark, folder):
    land(folder("landed"), DAY, "Boston", COMPLETE)
    land_bronze(spark, folder("landed"), folder("bronze"), "s")
    jobs.ingest(spark, folder("bronze"), folder("silver"))
    before = rows(read_silver(spark, folder("silver")))
    land(folder("landed"), DAY, "Boston", document(hours("2026-01-25T15:00", temperature_2m=[9.0])))
    land(folder("landed"), "2026-01-26", "Boston", document(hours("2026-01-26T12:00", "2026-01-26T12:00")))
    land_bronze(spark, folder("landed"), folder("bronze"), "s")
    with pytest.raises(ValueError, match="duplicates on natural key"):
        jobs.ingest(spark, folder("bronze"), folder("silver"))
    assert rows(read_silver(spark, folder("silver"))) == before


def test_empty_silver_frame(spark, folder):
    with pytest.raises(ValueError, match="empty"):
        write_silver(silver(spark, []), folder("silver"))


TWO_DAYS = [
    ("2026-01-25T00:00:00", -1.0, 50, 0.0, 1.0, "Boston"), ("2026-01-25T01:00:00", None, 51, 0.1, 2.0, "Boston"),
    ("2026-01-26T00:00:00", 0.0, None, None, None, "New York"),
]


def test_overwrite_touches_only_given_partitions(spark, folder):
    write_silver(silver(spark, TWO_DAYS), folder("silver"))
    write_silver(silver(spark, [("2026-01-26T05:00:00", 7.0, 1, 1.0, 1.0, "New York")]), folder("silver"))
    assert rows(read_silver(spark, folder("silver")), "temperature_2m") == [(-1.0,), (7.0,), (None,)]


def test_mirror_skips_existing_partitions(spark, folder):
    mirror(silver(spark, TWO_DAYS[:2]), folder("copy"))
    changed = silver(spark, TWO_DAYS).withColumn("temperature_2m", F.lit(5.0))
    mirror(changed, folder("copy"), check_exists=True)
    assert rows(read_silver(spark, folder("copy")), "temperature_2m") == [(-1.0,), (5.0,), (None,)]
    mirror(changed, folder("copy"))
    assert rows(read_silver(spark, folder("copy")), "temperature_2m") == [(5.0,)] * 3


def test_curate(spark):
    gold = curate(silver(spark, TWO_DAYS))
    assert rows(gold, "temp_celsius", "temp_fahrenheit", "is_freezing") == [
        (-1.0, 30.2, True), (0.0, 32.0, True), (None, None, False),
    ]
    assert dict(gold.dtypes)["time"] == "timestamp_ntz"


def test_curate_has_no_shuffle(spark, folder):
    write_silver(silver(spark, TWO_DAYS), folder("silver"))
    plan = curate(read_silver(spark, folder("silver"), [DAY]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert f"run_date" in plan.split("PartitionFilters")[1][:80]


def test_gold_rerun_is_idempotent(spark, folder):
    write_silver(silver(spark, TWO_DAYS), folder("silver"))
    first = jobs.curate_job(spark, folder("silver"), folder("gold"))
    before = rows(read_gold(spark, folder("gold")))
    assert jobs.curate_job(spark, folder("silver"), folder("gold") + "/") == first == 3
    assert rows(read_gold(spark, folder("gold"))) == before
    files = read_gold(spark, folder("gold"), ["2026-01-26"]).inputFiles()
    jobs.curate_job(spark, folder("silver"), folder("gold"), [DAY])
    assert read_gold(spark, folder("gold"), ["2026-01-26"]).inputFiles() == files and len(files) == 1


def test_reconcile_fails_before_the_write(spark, folder, monkeypatch):
    from isobar.sources import gold as gold_source

    monkeypatch.setattr(gold_source, "curate", lambda s: curate(s).union(curate(s).limit(1)))
    with pytest.raises(ValueError, match="silver 3, gold 4"):
        write_gold(silver(spark, TWO_DAYS), folder("gold"))
    assert not os.path.exists(folder("gold"))


def test_given_dates_are_the_only_folders_listed(spark, folder):
    write_silver(silver(spark, TWO_DAYS), folder("silver"))
    jobs.curate_job(spark, folder("silver"), folder("gold"))
    for read in (read_silver, read_gold):
        found = read(spark, folder("silver" if read is read_silver else "gold"), ["2026-01-26", "1999-01-01"])
        assert [str(r["run_date"]) for r in found.collect()] == ["2026-01-26"]
        assert all("run_date=2026-01-26" in path for path in found.inputFiles())
    assert read_silver(spark, folder("silver"), ["1999-01-01"]).count() == 0


def test_bronze_for_given_dates(spark, folder):
    for day in (DAY, "2026-01-26"):
        land(folder("landed"), day, "Boston", COMPLETE)
    land_bronze(spark, folder("landed"), folder("bronze"), "s")
    assert read_bronze(spark, folder("bronze"), [DAY]).count() == 1
    assert read_bronze(spark, folder("bronze"), ["1999-01-01"]).count() == 0
    assert read_bronze(spark, folder("bronze"), None, ["Salem"]).count() == 0


def test_dated_reads_list_once_however_many_dates(spark, folder, monkeypatch):
    from isobar.sources import layout

    write_silver(silver(spark, [("2026-01-25 10:00:00", 1.0, 50, 0.0, 1.0, "Boston")]), folder("silver"))
    calls = []
    plain = layout._file_system
    monkeypatch.setattr(layout, "_file_system", lambda *a: calls.append(a) or plain(*a))
    counts = []
    for n in (10, 1000):
        calls.clear()
        days = [f"{2000 + i // 12}-{i % 12 + 1:02d}-25" for i in range(n)]
        found = layout.date_folders(spark, folder("silver"), [*days, "2026-01-25"], by_source=True)
        assert [path.rsplit("/", 1)[1] for path in found] == ["run_date=2026-01-25"]
        counts.append(len(calls))
    assert counts[0] == counts[1] <= 2


@pytest.mark.parametrize("is_uri", [True, False])
def test_names_from_paths(spark, is_uri):
    from isobar.sources.layout import partition_from_path

    names = {
        "St. John's": ("St. John%27s", "St.%20John%2527s"), "A:B": ("A%3AB", "A%253AB"), "50%": ("50%25", "50%2525"),
        "a=b": ("a%3Db", "a%253Db"), "x+y z": ("x+y z", "x+y%20z"), None: ("__HIVE_DEFAULT_PARTITION__",) * 2,
    }
    paths = [(name, f"file:/r/run_date=2026-01-25/location={pair[is_uri]}/part-0.parquet") for name, pair in names.items()]
    table = spark.createDataFrame(paths, "name string, path string")
    found = table.select("name", partition_from_path(F.col("path"), "location", is_uri)).collect()
    assert all(row[0] == row[1] for row in found)


def test_other_hourly_arrays_come_back(spark, folder):
    """Numbers, texts, truth values, nested values and nulls of arrays nobody declared; documents without any; older files without the column."""
    other = {"cloud_cover": [12.5, None], "note": ['say "x"', "ß"], "flag": [True, False], "nested": [{"a": [1]}, []], "scalar": 5, "empty name": [1, 2]}
    land(folder("landed"), DAY, "Boston", document({**COMPLETE["hourly"], **other}))
    land(folder("landed"), "2026-01-26", "Boston", document(hours("2026-01-26T12:00", temperature_2m=[1.0])))
    land_bronze(spark, folder("landed"), folder("bronze"), "s")
    jobs.ingest(spark, folder("bronze"), folder("silver"))
    write_silver(silver(spark, [("2026-01-27T05:00:00", 7.0, 1, 1.0, 1.0, "Boston")]), folder("silver"))
    for root in (folder("silver"), folder("copy")):
        found = read_silver(spark, root, others=True).orderBy("time").collect()
        assert [r.other_hourly for r in found] == [
            {"cloud_cover": "12.5", "note": '"say \\"x\\""', "flag": "true", "nested": '{"a":[1]}', "empty name": "1"},
            {"cloud_cover": None, "note": '"ß"', "flag": "false", "nested": "[]", "empty name": "2"},
            None, None,
        ]
        if root == folder("silver"):
            mirror(read_silver(spark, root, others=True), folder("copy"))
    assert "other_hourly" not in read_silver(spark, folder("silver")).columns
    assert jobs.curate_job(spark, folder("silver"), folder("gold")) == 4

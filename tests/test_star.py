"""Dimensions, fact, merges."""

import os
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from isobar.functions.keys import dense_ids
from isobar.operators.curate import curate
from isobar.operators.merge import merge_dim_location, merge_fact, promote_fact
from isobar.operators.quality import star_constraints
from isobar.operators.star import build_dim_date, build_dim_location, coordinate_conflicts
from isobar.plans import jobs
from isobar.plans.hourly import QUESTIONS
from isobar.sources.warehouse import FACT_TABLE, Warehouse
from samples import rows, silver

FIRST = [
    ("2026-01-24T00:00:00", 1.0, 50, 0.0, 1.0, "Boston"), ("2026-01-24T01:00:00", 2.0, 51, 0.1, 2.0, "Boston"),
    ("2026-01-25T00:00:00", 3.0, 52, 0.2, 3.0, "Boston"), ("2026-02-01T00:00:00", 4.0, 53, 0.3, 4.0, "Boston"),
]
SECOND = [
    ("2026-01-25T00:00:00", None, 60, 9.0, 9.0, "Boston"), ("2026-01-25T01:00:00", 7.0, 61, 9.1, 9.1, "Boston"),
    ("2026-03-01T05:00:00", 8.0, 62, 9.2, 9.2, "Salem"),
]


def gold(spark, data, **kw):
    return curate(silver(spark, data, **kw))


def facts(warehouse):
    star = jobs.read_star(warehouse)
    named = star.name(star.fact)
    return rows(named, F.col("date_value").cast("string"), "location_name", "hour", "temp_celsius", "humidity_percent")


def test_date_dimension(spark):
    dates = build_dim_date(silver(spark, FIRST))
    assert rows(dates, "date_id", "year", "month", "day", "day_of_week", "is_weekend") == [
        (20260124, 2026, 1, 24, 6, True), (20260125, 2026, 1, 25, 0, True), (20260201, 2026, 2, 1, 0, True),
    ]


def test_location_without_name_is_left_out(spark):
    staged = silver(spark, [*FIRST, ("2026-01-24T00:00:00", 1.0, 1, 1.0, 1.0, None)])
    assert rows(build_dim_location(staged), "location_id", "location_name") == [(1, "Boston")]


def test_location_with_two_coordinate_pairs_fails(spark):
    staged = silver(spark, FIRST[:1]).union(silver(spark, FIRST[1:2], coordinates=(1.0, 2.0)))
    assert coordinate_conflicts(staged).count() == 1
    with pytest.raises(Exception, match="two coordinate pairs: Boston"):
        build_dim_location(staged).collect()


def test_dense_ids_are_dense_and_repeatable(spark):
    names = spark.range(5000).select(F.concat(F.lit("n"), F.col("id")).alias("name"))
    first = rows(dense_ids(names, "name", "key", 10))
    assert sorted(k for _n, k in first) == list(range(11, 5011))
    assert rows(dense_ids(names.repartition(3), "name", "key", 10)) == first


@pytest.mark.parametrize("grain", ["day", "month"])
def test_upsert(spark, folder, grain):
    warehouse = Warehouse(spark, folder("w"), grain)
    jobs.load_staged(warehouse, gold(spark, FIRST))
    february = ("date_id", [20260201]) if grain == "day" else ("month_id", [202602])
    files = sorted(warehouse.read_fact_folders(*february).inputFiles())
    ids = {tuple(r)[:3]: r[3] for r in rows(warehouse.read(FACT_TABLE), "date_id", "location_id", "hour", "fact_id")}
    jobs.load_staged(warehouse, gold(spark, SECOND))
    assert facts(warehouse) == sorted([
        ("2026-01-24", "Boston", 0, 1.0, 50), ("2026-01-24", "Boston", 1, 2.0, 51),
        ("2026-01-25", "Boston", 0, None, 60), ("2026-01-25", "Boston", 1, 7.0, 61),
        ("2026-02-01", "Boston", 0, 4.0, 53), ("2026-03-01", "Salem", 5, 8.0, 62),
    ], key=repr)
    assert sorted(warehouse.read_fact_folders(*february).inputFiles()) == files and len(files) == 1
    after = {tuple(r)[:3]: r[3] for r in rows(warehouse.read(FACT_TABLE), "date_id", "location_id", "hour", "fact_id")}
    assert ids.items() <= after.items() and len(set(after.values())) == 6
    assert {r["n_failures"] for r in star_constraints(jobs.read_star(warehouse)).collect()} == {0}


def test_merge_twice_changes_nothing(spark, folder):
    warehouse = Warehouse(spark, folder("w"))
    jobs.load_staged(warehouse, gold(spark, FIRST + SECOND[1:]))
    before = facts(warehouse), rows(warehouse.read("dim_location")), rows(warehouse.read("dim_date"))
    jobs.load_staged(warehouse, gold(spark, FIRST + SECOND[1:]))
    assert (facts(warehouse), rows(warehouse.read("dim_location")), rows(warehouse.read("dim_date"))) == before


def test_merge_without_new_rows_adds_no_file(spark, folder):
    warehouse = Warehouse(spark, folder("w"))
    jobs.load_staged(warehouse, gold(spark, FIRST))
    before = {t: sorted(os.listdir(warehouse.path(t))) for t in ("dim_date", "dim_location")}
    jobs.load_staged(warehouse, gold(spark, FIRST))
    assert {t: sorted(os.listdir(warehouse.path(t))) for t in before} == before


def test_known_location_is_never_updated(spark, folder):
    warehouse = Warehouse(spark, folder("w"))
    merge_dim_location(warehouse, gold(spark, FIRST))
    merge_dim_location(warehouse, gold(spark, SECOND, coordinates=(0.0, 0.0)))
    assert rows(warehouse.read("dim_location")) == [(1, "Boston", 42.36, -71.06), (2, "Salem", 0.0, 0.0)]


def test_two_source_rows_for_one_key_fail_and_leave_the_fact(spark, folder):
    warehouse = Warehouse(spark, folder("w"))
    jobs.load_staged(warehouse, gold(spark, FIRST))
    before = facts(warehouse)
    with pytest.raises(Exception, match="Two source rows for fact key"):
        jobs.load_staged(warehouse, gold(spark, [SECOND[0], SECOND[0]]))
    assert facts(warehouse) == before


def test_empty_source_touches_nothing(spark, folder):
    warehouse = Warehouse(spark, folder("w"))
    jobs.load_staged(warehouse, gold(spark, FIRST))
    assert merge_fact(warehouse, warehouse.read(FACT_TABLE).limit(0)) == 0
    assert len(facts(warehouse)) == 4


def test_a_version_can_be_published_again(spark, folder):
    from isobar.sources import snapshots
    from isobar.sources.warehouse import with_fact_folder

    warehouse = Warehouse(spark, folder("w"))
    jobs.load_staged(warehouse, gold(spark, FIRST))
    other = Warehouse(spark, folder("copy"))
    jobs.load_staged(other, gold(spark, SECOND))
    rows_of_other = with_fact_folder(other.read(FACT_TABLE), "date_id")
    version = snapshots.write_version(rows_of_other, warehouse.path(FACT_TABLE), ["date_id"]).name
    assert warehouse.read(FACT_TABLE).count() == 4
    for _ in range(2):
        promote_fact(warehouse, version)
    assert warehouse.read(FACT_TABLE).count() == 4 - 1 + 3


def test_reload_and_merge_give_the_same_star(spark, folder):
    data = FIRST + SECOND[1:]
    merged = Warehouse(spark, folder("merged"))
    jobs.load_staged(merged, gold(spark, data))
    for _ in range(2):  # a reload replaces
        reloaded = jobs.load_full(Warehouse(spark, folder("full")), silver(spark, data))
    star = jobs.read_star(merged)
    names = ["fact_id", "date_id", "location_id", "hour", "temperature_2m", "precipitation"]
    assert rows(reloaded.locations) == rows(star.locations)
    assert rows(reloaded.feed_named().fact, *names) == rows(star.feed_named().fact, *names)


def test_a_reload_can_be_followed_by_merges(spark, folder):
    """One object, one naming: hours that the merge does not bring keep their measures."""
    for grain in ("day", "month"):
        warehouse = Warehouse(spark, folder(f"w-{grain}"), grain)
        jobs.load_full(warehouse, silver(spark, FIRST))
        before = facts(warehouse)
        jobs.load_staged(warehouse, gold(spark, SECOND[:1]))
        whole = Warehouse(spark, folder(f"whole-{grain}"), grain)
        jobs.load_staged(whole, gold(spark, FIRST))
        jobs.load_staged(whole, gold(spark, SECOND[:1]))
        assert facts(warehouse) == facts(whole) != before


def test_another_grain_is_refused_and_none_follows_the_table(spark, folder):
    jobs.load_staged(Warehouse(spark, folder("w"), "month"), gold(spark, FIRST))
    with pytest.raises(ValueError, match="laid out by month_id"):
        jobs.load_staged(Warehouse(spark, folder("w"), "day"), gold(spark, SECOND))
    jobs.load_staged(Warehouse(spark, folder("w")), gold(spark, SECOND))
    assert Warehouse(spark, folder("w")).fact_folder == "month_id"
    assert len(facts(Warehouse(spark, folder("w")))) == 4 - 1 + 3


def test_repeated_rows_fail_a_reload(spark, folder):
    warehouse = Warehouse(spark, folder("w"))
    jobs.load_full(warehouse, silver(spark, FIRST))
    before = facts(warehouse)
    with pytest.raises(Exception, match="Two source rows for fact key"):
        jobs.load_full(warehouse, silver(spark, [FIRST[0], FIRST[0]]))
    assert facts(warehouse) == before


def test_a_swap_cut_short_leaves_the_old_table(spark, folder, monkeypatch):
    from isobar.sources import layout

    warehouse = Warehouse(spark, folder("w"))
    jobs.load_staged(warehouse, gold(spark, FIRST))
    before, table = facts(warehouse), warehouse.path(FACT_TABLE)
    with pytest.raises(RuntimeError):
        layout.swap_in(spark, folder("nothing-here"), table)  # fails after the old table was moved aside
    assert facts(warehouse) == before
    os.rename(table, layout.beside(layout._aside(table), ""))  # as a crash between the two steps leaves it
    assert facts(Warehouse(spark, folder("w"))) == before


def test_fact_id_has_a_range(spark):
    from isobar.functions.calendar import fact_id

    keys = spark.createDataFrame([(20260124, 2**27 - 1, 23)], "d int, l bigint, h int")
    assert keys.select(fact_id(F.col("d"), F.col("l"), F.col("h"))).first()[0] > 0
    with pytest.raises(Exception, match="No fact id"):
        keys.select(fact_id(F.col("d"), F.col("l") + 1, F.col("h"))).collect()


def test_rebuild_empties_the_tables(spark, folder):
    warehouse = Warehouse(spark, folder("w"))
    jobs.load_staged(warehouse, gold(spark, FIRST))
    warehouse.rebuild()
    assert [warehouse.read(t).count() for t in ("dim_date", "dim_location", FACT_TABLE)] == [0, 0, 0]


def test_upsert_reads_only_touched_folders(spark, folder):
    warehouse = Warehouse(spark, folder("w"))
    jobs.load_staged(warehouse, gold(spark, FIRST))
    touched = warehouse.read_fact_folders("date_id", [20260125, 20991231])
    assert rows(touched, "date_id") == [(20260125,)]
    assert all("date_id=20260125" in path for path in touched.inputFiles())
    assert warehouse.read_fact_folders("date_id", [20991231]).count() == 0


def test_a_hot_day_is_written_by_several_tasks(spark, folder):
    """Rows of one day are cut by size, other days still get one file each."""
    from isobar.sources.layout import aligned

    hot = spark.range(200_000).select((F.col("id") % 100 > 2).cast("int").alias("day"), F.rand(1).alias("x"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        aligned(hot, ["day"]).write.partitionBy("day").parquet(folder("out"))
    finally:
        spark.conf.set(key, before)
    files = {day: len([f for f in os.listdir(f"{folder('out')}/day={day}") if f.endswith("parquet")]) for day in (0, 1)}
    assert files[0] == 1 and files[1] > 2


def test_failed_reload_keeps_the_old_tables(spark, folder):
    warehouse = Warehouse(spark, folder("w"))
    before = rows(jobs.load_full(warehouse, silver(spark, FIRST)).locations)
    moved = silver(spark, FIRST[:1]).union(silver(spark, FIRST[1:2], coordinates=(1.0, 2.0)))
    with pytest.raises(Exception, match="two coordinate pairs"):
        jobs.load_full(warehouse, moved)
    assert rows(warehouse.read("dim_location")) == before


def test_a_table_can_be_replaced_from_itself(spark, folder):
    warehouse = Warehouse(spark, folder("w"), "month")
    jobs.load_staged(warehouse, gold(spark, FIRST))
    warehouse.replace(FACT_TABLE, warehouse.read(FACT_TABLE).where("hour = 0"))
    assert warehouse.read(FACT_TABLE).count() == 3


def test_tables_answer_sql_by_name(spark, folder):
    warehouse = Warehouse(spark, folder("w"))
    jobs.load_staged(warehouse, gold(spark, FIRST))
    assert set(warehouse.register()) >= {"dim_date", "dim_location", FACT_TABLE}
    found = spark.sql(
        "SELECT l.location_name, d.day, count(*) n FROM fact_weather_hourly f JOIN dim_date d USING (date_id) "
        "JOIN dim_location l USING (location_id) GROUP BY ALL"
    )
    assert rows(found) == [("Boston", 1, 1), ("Boston", 24, 2), ("Boston", 25, 1)]


def plan_of(df, capsys, mode="formatted"):
    capsys.readouterr()
    df.explain(mode)
    return capsys.readouterr().out


def test_plans(spark, folder, capsys):
    """Filters and columns reach the scan, weekend days prune folders, no query crosses tables."""
    from isobar.plans.hourly import QUESTIONS

    warehouse = Warehouse(spark, folder("w"))
    jobs.load_staged(warehouse, gold(spark, FIRST))
    feed = jobs.read_star(warehouse).feed_named()
    assert "LessThan(temp_celsius,0.0)" in plan_of(QUESTIONS["q2"](feed), capsys)
    assert "GreaterThan(wind_speed_kmh,15.0)" in plan_of(QUESTIONS["q3"](feed), capsys)
    assert "dynamicpruning" in plan_of(QUESTIONS["q4"](feed), capsys)
    rain = plan_of(QUESTIONS["q7"](feed), capsys)
    assert "ReadSchema: struct<location_id:int,precipitation_mm:double>" in rain
    assert "TakeOrderedAndProject" in plan_of(QUESTIONS["q1"](feed), capsys)
    for question in QUESTIONS.values():
        plan = plan_of(question(feed), capsys)
        assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_staging_types(spark, folder):
    """Replacing staging keeps the declared types: a run date stays a date."""
    warehouse = Warehouse(spark, folder("w"))
    loose = silver(spark, FIRST).withColumn("run_date", F.col("run_date").cast("string"))
    jobs.load_full(warehouse, loose)
    types = dict(warehouse.read("raw_weather").dtypes)
    assert (types["run_date"], types["time"], types["relative_humidity_2m"]) == ("date", "timestamp_ntz", "int")


def test_zero_degrees(spark, folder):
    """Zero is freezing in gold and not among the hours below freezing."""
    from isobar.plans.hourly import QUESTIONS

    zero = [("2026-01-24T00:00:00", 0.0, 50, 0.0, 1.0, "Boston")]
    assert gold(spark, zero).first()["is_freezing"]
    warehouse = Warehouse(spark, folder("w"))
    jobs.load_staged(warehouse, gold(spark, zero))
    assert QUESTIONS["q2"](jobs.read_star(warehouse).feed_named()).count() == 0


@pytest.mark.parametrize("grain", ["day", "month"])
def test_a_week_opens_its_folders_only(spark, folder, grain):
    """84 months of readings; a week's star reads the one or two months it lies in."""
    data = [
        (f"{year}-{month:02d}-{day:02d}T0{hour}:00:00", float(day), 50, 0.0, 1.0, "Boston")
        for year in range(2020, 2027) for month in range(1, 13) for day in (1, 15, 28) for hour in (0, 5)
    ]
    warehouse = Warehouse(spark, folder("w"), grain)
    jobs.load_full(warehouse, silver(spark, data))
    assert len(jobs.read_star(warehouse).fact.inputFiles()) >= 84
    for first, last, days, folders in (("2023-04-27", "2023-05-03", 2, 2), ("2023-05-10", "2023-05-16", 1, 1), ("2031-01-01", "2031-01-07", 0, 0)):
        week = jobs.read_star(warehouse, first, last)
        assert len({path.rsplit("/", 2)[1] for path in week.fact.inputFiles()}) == folders
        assert week.fact.count() == 2 * days == week.fact.join(week.dates, "date_id").count()
    assert rows(QUESTIONS["q4"](jobs.read_star(warehouse, "2023-01-01", "2023-01-31").feed_named()), "date_value", "hour") == [
        (date(2023, 1, day), hour) for day in (1, 15, 28) for hour in (0, 5)
    ]


def test_constraints_read_every_table_once(spark, folder):
    warehouse = Warehouse(spark, folder("w"))
    jobs.load_staged(warehouse, gold(spark, FIRST))
    found = star_constraints(jobs.read_star(warehouse))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 3 or plan.count("Scan parquet") == 3
    empty = star_constraints(jobs.read_star(Warehouse(spark, folder("none"))))
    assert {r.n_failures for r in empty.collect()} == {0} and empty.count() == 17


def test_constraints_compare_numbers_as_numbers(spark, folder):
    """The fact's keys are not turned into texts, and missing or repeated values are found as before."""
    warehouse = Warehouse(spark, folder("w"))
    jobs.load_staged(warehouse, gold(spark, FIRST))
    star = jobs.read_star(warehouse)
    plan = star_constraints(star)._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"cast\((fact_id|location_id)#\d+L? as string\)", plan)

    spoilt = star.fact.withColumns({
        "fact_id": F.when(F.col("date_id") > 20260124, F.col("fact_id")),
        "location_id": F.when(F.col("hour") == 0, F.col("location_id")).otherwise(F.lit(77)),
        "hour": F.when(F.col("date_id") < 20260201, F.col("hour")),
    })
    nameless = star.locations.withColumn("location_name", F.lit(None).cast("string"))
    broken = jobs.Star(spoilt.unionByName(spoilt), star.dates.where("date_id <> 20260125"), star.locations.unionByName(nameless))
    failing = {(r["table_name"], r["constraint_type"], r["column_name"]): r["n_failures"] for r in star_constraints(broken).where("n_failures > 0").collect()}
    fact = "fact_weather_hourly"
    assert failing == {
        (fact, "unique", "fact_id"): 2, (fact, "not_null", "fact_id"): 4, (fact, "not_null", "hour"): 2,
        (fact, "foreign_key", "date_id"): 1, (fact, "foreign_key", "location_id"): 1,
        ("dim_location", "unique", "location_id"): 1, ("dim_location", "not_null", "location_name"): 1,
    }

"""Mart, spine, metrics, dashboard, quality checks."""

import pytest
from pyspark.sql import functions as F

from isobar.operators import quality
from isobar.operators.curate import curate
from isobar.plans import dashboard, jobs, marts, metrics
from isobar.sources.warehouse import Warehouse
from samples import document, hours, land, rows, silver

ROWS = [
    ("2026-01-24T00:00:00", 1.0, 50, 0.0, 1.0, "Boston"), ("2026-01-24T01:00:00", 2.5, 51, 0.1, 2.0, "Boston"),
    ("2026-01-24T02:00:00", None, None, None, None, "Boston"),
    ("2026-01-26T00:00:00", 3.0, 52, 0.2, 3.0, "Boston"), ("2026-02-01T00:00:00", None, 53, None, 4.0, "Salem"),
]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("w")))
    jobs.load_staged(warehouse, curate(silver(spark, ROWS)))
    return warehouse, jobs.build_marts(warehouse)


@pytest.fixture(scope="module")
def mart(built):
    return built[0].read("mart_daily_weather_summary")


def test_mart(built, mart):
    assert {name: failing.count() for name, failing in built[1].items()} == dict.fromkeys(built[1], 0)
    found = rows(
        mart, F.col("summary_date").cast("string"), "location_name", "is_weekend", "min_temp_c", "max_temp_c",
        "avg_temp_c", "avg_humidity", "total_precipitation_mm", "max_wind_speed_kmh",
    )
    assert found == [
        ("2026-01-24", "Boston", True, 1.0, 2.5, 1.75, 50.5, 0.1, 2.0),
        ("2026-01-26", "Boston", False, 3.0, 3.0, 3.0, 52.0, 0.2, 3.0),
        ("2026-02-01", "Salem", True, None, None, None, 53.0, None, 4.0),
    ]
    ids = mart.select("summary_id", F.concat_ws("-", "location_id", "date_id").alias("x"))
    assert ids.where("summary_id <> x").count() == 0


def test_staging_views_are_named(spark, built):
    marts.staging_views(built[0])
    assert spark.table("stg_weather_hourly").columns == [
        "fact_id", "date_id", "location_id", "hour", "temp_celsius", "humidity_percent",
        "precipitation_mm", "wind_speed_kmh", "extraction_time",
    ]
    assert spark.table("stg_date").count() == 3 and spark.table("stg_location").count() == 2


def test_time_spine(built):
    spine = built[0].read("metricflow_time_spine").agg(F.min("date_day"), F.max("date_day"), F.count("*")).first()
    assert [str(v) for v in spine] == ["2020-01-01", "2029-12-28", "3650"]


def test_metrics(mart):
    everything = metrics.metric_query(mart, metrics.METRICS).first()
    assert tuple(everything) == (2.375, 0.3, 4.0)  # the average of averages, unweighted
    by_month = metrics.metric_query(mart, ["max_daily_wind_speed"], ["summary_date"], grain="month")
    assert rows(by_month, F.col("summary_date").cast("string"), "max_daily_wind_speed") == [
        ("2026-01-01", 3.0), ("2026-02-01", 4.0),
    ]
    weekend = metrics.metric_query(mart, ["total_daily_precipitation"], ["location_name"], where="is_weekend")
    assert rows(weekend) == [("Boston", 0.1), ("Salem", None)]


def test_metric_names_are_checked(mart):
    with pytest.raises(KeyError, match="Unknown metrics: rain"):
        metrics.metric_query(mart, ["rain"])
    with pytest.raises(KeyError, match="Not a dimension"):
        metrics.metric_query(mart, ["max_daily_wind_speed"], ["avg_temp_c"])
    with pytest.raises(ValueError, match="grain"):
        metrics.metric_query(mart, ["max_daily_wind_speed"], ["summary_date"], grain="hour")


def test_filters(mart):
    def days(**kw):
        return [d for (d,) in rows(dashboard.filter_mart(mart, **kw), F.col("summary_date").cast("string"))]

    assert days() == ["2026-01-24", "2026-01-26", "2026-02-01"]
    assert days(start="2026-01-24", end="2026-01-26") == ["2026-01-24", "2026-01-26"]
    assert days(start="2026-01-26") == ["2026-01-26"]
    assert days(location="Salem") == ["2026-02-01"]
    assert len(days(location=dashboard.ALL_LOCATIONS)) == 3


def test_filter_reaches_the_scan(mart, capsys):
    dashboard.filter_mart(mart, "2026-01-24", "2026-01-26", "Boston").explain("formatted")
    pushed = next(line for line in capsys.readouterr().out.splitlines() if "PushedFilters" in line)
    assert "EqualTo(location_name,Boston)" in pushed and "GreaterThanOrEqual(summary_date" in pushed


def test_kpis(mart):
    assert tuple(dashboard.kpis(mart).first()) == (2.375, 0.3, 4.0, (50.5 + 52 + 53) / 3)
    assert tuple(dashboard.kpis(mart.limit(0)).first()) == (0.0, 0.0, 0.0, 0.0)
    dry = dashboard.filter_mart(mart, location="Salem")
    assert tuple(dashboard.kpis(dry).first()) == (None, 0.0, 4.0, 53.0)


def test_trends(mart):
    temps = rows(dashboard.temp_trend(mart), F.col("summary_date").cast("string"), "avg_temp_c")
    assert temps == [("2026-01-24", 1.75), ("2026-01-26", 3.0), ("2026-02-01", None)]
    rain = rows(dashboard.precip_trend(mart), F.col("summary_date").cast("string"), "total_precipitation_mm")
    assert rain == [("2026-01-24", 0.1), ("2026-01-26", 0.2), ("2026-02-01", 0.0)]
    assert dashboard.wind_humidity(mart, "Boston").columns == ["avg_humidity", "max_wind_speed_kmh"]
    assert dashboard.wind_humidity(mart).columns[-1] == "location_name"


def test_options_and_freshness(mart):
    assert rows(dashboard.filter_options(mart)) == [
        ("location", "Boston"), ("location", "Salem"), ("max_date", "2026-02-01"), ("min_date", "2026-01-24"),
    ]
    assert [str(v) for v in dashboard.freshness(mart).first()] == ["2026-01-24", "2026-02-01"]
    shouting = mart.toDF(*[name.upper() for name in mart.columns])
    newest = dashboard.newest_first(shouting)
    assert newest.columns == mart.columns and str(newest.first()["summary_date"]) == "2026-02-01"


def test_quality(spark, built):
    star = jobs.read_star(built[0])
    assert tuple(quality.row_count(star.fact, "t").first()) == ("t", 5)
    assert tuple(quality.null_counts(star.fact).first()) == (5, 2, 2, 0)
    assert tuple(quality.null_counts(star.fact.limit(0)).first()) == (0, None, None, None)
    assert rows(quality.proof_join(star), F.col("date_value").cast("string"), "hour")[-1] == ("2026-02-01", 0)
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    parent = spark.createDataFrame([(2,), (None,)], "k int")
    assert rows(quality.relationships(child, "k", parent, "k")) == [(1, 2)]
    assert rows(quality.unique(child, ["k"])) == [(1, 2)]
    assert rows(quality.not_null(child, ["k"])) == [("k", 2)]
    assert rows(quality.duplicate_rows(child, ["k"])) == [(1, 2), (None, 2)]


def test_constraints_find_faults(spark, built):
    star = jobs.read_star(built[0])
    broken = jobs.Star(star.fact.union(star.fact.limit(1)), star.dates.limit(1), star.locations.union(star.locations))
    failing = {
        (r["table_name"], r["constraint_type"], r["column_name"]): r["n_failures"]
        for r in quality.star_constraints(broken).where("n_failures > 0").collect()
    }
    assert failing == {
        ("fact_weather_hourly", "unique", "fact_id"): 1, ("fact_weather_hourly", "foreign_key", "date_id"): 2,
        ("dim_location", "unique", "location_id"): 2, ("dim_location", "unique", "location_name"): 2,
    }


def test_backfill_twice(spark, folder):
    for day in ("2026-01-24", "2026-01-25", "2026-01-28"):
        land(folder("landed"), day, "Boston", document(hours(f"{day}T12:00", f"{day}T13:00", temperature_2m=[1.5, 2.5])))
    jobs.land_bronze(spark, folder("landed"), folder("bronze"), "stations")
    warehouse = Warehouse(spark, folder("w"))
    counts = []
    for _ in range(2):
        tests = jobs.backfill(
            spark, folder("bronze"), folder("silver"), folder("gold"), warehouse, "2026-01-24", "2026-01-27"
        )
        star = jobs.read_star(warehouse)
        counts.append((star.fact.count(), star.dates.count(), warehouse.read("mart_daily_weather_summary").count()))
        assert all(failing.count() == 0 for failing in tests.values())
    assert counts == [(4, 2, 2)] * 2

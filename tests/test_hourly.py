"""The hourly questions against plain Python over a small, skewed history."""

import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from isobar.operators.curate import curate
from isobar.operators.neighbours import with_earlier
from isobar.operators.star import Star, build_dim_date, build_dim_location, build_fact
from isobar.plans.hourly import QUESTIONS
from samples import rows, silver


def history():
    """One location holds a third of the rows; days span four years with gaps."""
    rng = random.Random(11)
    days = [date(2023, 12, 20) + timedelta(days=rng.randrange(900)) for _ in range(60)]
    slots = {("big", d, h) for d in days for h in rng.sample(range(24), 5)}
    while len(slots) < 900:
        slots.add((f"small {rng.randrange(9)}", rng.choice(days), rng.randrange(24)))
    data = []
    for place, day, hour in sorted(slots):
        temp = None if rng.random() < 0.1 else rng.randrange(-100, 400) / 10
        rain = None if rng.random() < 0.1 else rng.choice([0.0, rng.randrange(50) / 10])
        data.append((f"{day}T{hour:02}:00:00", temp, rng.randrange(100), rain, rng.randrange(300) / 10, place))
    return data


DATA = history()


@pytest.fixture(scope="module")
def star(spark):
    staged = silver(spark, DATA).cache()
    dates, locations = build_dim_date(staged), build_dim_location(staged)
    return Star(build_fact(staged, dates, locations), dates, locations).feed_named()


def by_location(order):
    groups = defaultdict(list)
    for text, temp, _humidity, rain, _wind, place in DATA:
        groups[place].append((text[:10], int(text[11:13]), temp, rain))
    return {place: sorted(values, key=order) for place, values in groups.items()}


def by_day():
    groups = defaultdict(list)
    for text, temp, _humidity, rain, _wind, place in DATA:
        groups[place, text[:10]].append((text[:10], int(text[11:13]), temp, rain))
    return {(place, day): sorted(v, key=lambda r: r[1]) for (place, day), v in groups.items()}


def one_decimal(value):
    return float(Decimal(value).quantize(Decimal("0.1"), ROUND_HALF_UP))


def history_order(row):
    return (row[1], row[0])


def sequences(daily):
    return [(k[0], v) for k, v in by_day().items()] if daily else list(by_location(history_order).items())


def result(star, name, *columns):
    frame = QUESTIONS[name](star)
    return rows(frame, "location_name", F.col("date_value").cast("string"), "hour", *columns)


@pytest.mark.parametrize("name,daily", [("q9", False), ("q9_daily", True)])
def test_change(star, name, daily):
    expected = []
    for place, values in sequences(daily):
        before = None
        for day, hour, temp, _rain in values:
            change = None
            if temp is not None and before is not None:
                change = one_decimal(Decimal(str(temp)) - Decimal(str(before)))
            expected.append((place, day, hour, temp, before, change))
            before = temp
    assert result(star, name, "temperature_2m", "prev_hour_temp", "temp_change") == sorted(expected, key=repr)


@pytest.mark.parametrize("name,daily", [("q10", False), ("q10_daily", True)])
def test_rolling_average(star, name, daily):
    expected = []
    for place, values in sequences(daily):
        for at, (day, hour, temp, _rain) in enumerate(values):
            seen = [Decimal(str(v[2])) for v in values[max(0, at - 2):at + 1] if v[2] is not None]
            expected.append((place, day, hour, temp, one_decimal(sum(seen) / len(seen)) if seen else None))
    assert result(star, name, "temperature_2m", "moving_avg_3hr") == sorted(expected, key=repr)


def total(values):
    seen = [Decimal(str(v)) for v in values if v is not None]
    return float(sum(seen)) if seen else None


@pytest.mark.parametrize("name,daily", [("q12", False), ("q12_daily", True)])
def test_running_rain(star, name, daily):
    """Rows of the same hour are ties and share the total."""
    expected = []
    for place, values in sequences(daily):
        for day, hour, _temp, rain in values:
            expected.append((place, day, hour, rain, total(v[3] for v in values if v[1] <= hour)))
    assert result(star, name, "precipitation", "cumulative_precip") == sorted(expected, key=repr)


def test_rank_puts_missing_first(star):
    expected = []
    for (place, day), values in by_day().items():
        def heat(row):
            return float("inf") if row[2] is None else row[2]
        for row in values:
            rank = 1 + sum(heat(other) > heat(row) for other in values)
            expected.append((place, day, row[1], row[2], rank))
    assert result(star, "q11", "temperature_2m", "heat_rank") == sorted(expected, key=repr)


def test_daily_average(star):
    expected = []
    for (place, day), values in by_day().items():
        seen = [Decimal(str(v[2])) for v in values if v[2] is not None]
        expected.append((place, day, len(values), one_decimal(sum(seen) / len(seen)) if seen else None))
    frame = QUESTIONS["q5"](star)
    found = rows(frame, "location_name", F.col("date_value").cast("string"), "hours_recorded", "avg_temp")
    assert found == sorted(expected, key=repr)


def test_missing_temperature_is_hot(star):
    counts = defaultdict(int)
    for (place, day), values in by_day().items():
        for _day, _hour, temp, _rain in values:
            kind = "Hot" if temp is None or temp > 20 else "Mild" if temp >= 10 else "Cold"
            counts[place, day, kind] += 1
    frame = QUESTIONS["q8"](star)
    found = rows(frame, "location_name", F.col("date_value").cast("string"), "temp_category", "hours_count")
    assert found == sorted(((*k, n) for k, n in counts.items()), key=repr)


def test_orders(star):
    """Missing values come first going down and last going up."""
    temps = [r["avg_temp"] for r in QUESTIONS["q5"](star).collect()]
    known = [t for t in temps if t is not None]
    assert temps == [None] * (len(temps) - len(known)) + sorted(known, reverse=True)
    cold = [r["temperature_2m"] for r in QUESTIONS["q2"](star).collect()]
    assert cold == sorted(cold) and cold[-1] < 0
    assert len(QUESTIONS["q1"](star).collect()) == 10


def test_questions_take_gold_named_stars(spark, star):
    gold = curate(silver(spark, DATA))
    named = Star(build_fact(gold, star.dates, star.locations), star.dates, star.locations)
    assert rows(QUESTIONS["q7"](named.feed_named())) == rows(QUESTIONS["q7"](star))


@pytest.mark.parametrize("n", [1, 2, 3])
def test_earlier_values_across_blocks(spark, n):
    rng = random.Random(n)
    data = []
    for key in range(4):
        at = sorted(rng.sample(range(400), 60 if key else 150))
        data += [(key, p // 7, p, None if rng.random() < 0.2 else p) for p in at]
    frame = spark.createDataFrame(data, "key int, block int, at int, value int")
    found = with_earlier(frame, "key", ["block"], ["at"], "value", n)
    expected = []
    for key in range(4):
        values = [r for r in data if r[0] == key]
        for i, row in enumerate(values):
            expected.append((*row, *[values[i - k][3] if i >= k else None for k in range(1, n + 1)]))
    assert rows(found) == sorted(expected, key=repr)


def test_sums_keep_every_place(spark):
    from isobar.functions.exact import avg_tenths, exact_avg, exact_sum

    table = spark.createDataFrame([(0.00004,), (0.00004,), (0.00004,), (None,)], "x double")
    x = F.col("x")
    assert tuple(table.select(exact_sum(x), exact_avg(x)).first()) == (0.00012, 0.00004)
    halves = spark.createDataFrame([(0.25,), (-0.25,), (0.2499999999,)], "x double")
    assert [r[0] for r in halves.groupBy("x").agg(avg_tenths(x).alias("r")).orderBy("x").select("r").collect()] == [-0.3, 0.2, 0.3]
    assert table.where("x IS NULL").select(avg_tenths(x)).first()[0] is None


def _as_decimal(x):
    return Decimal(repr(x)).quantize(Decimal(1).scaleb(-18), ROUND_HALF_UP)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_are_those_of_the_texts(spark, ansi):
    """Millionths and other values, large ones and small ones, in any number of parts, with ANSI mode on and off."""
    from isobar.functions.exact import avg_tenths, combined_tenths, exact, exact_avg, exact_sum

    rng = random.Random(4)
    makers = [
        lambda: rng.randrange(-10**9, 10**9) / 10 ** rng.randrange(0, 7), lambda: rng.uniform(-50, 50), lambda: rng.uniform(-1e9, 1e10 - 1),
        lambda: rng.randrange(10**15) / 10**6, lambda: rng.random() / 10 ** rng.randrange(20), lambda: -0.0, lambda: None,
    ]
    data = [(i % 7, makers[rng.randrange(len(makers)) if i % 7 else 0]()) for i in range(4000)]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for parts in (1, 9):
            table = spark.createDataFrame(data, "g int, x double").repartition(parts)
            found = table.groupBy("g").agg(exact_sum(F.col("x")).alias("s"), exact_avg(F.col("x")).alias("a"), avg_tenths(F.col("x")).alias("t")).collect()
            for g, total, average, in_tenths in found:
                values = [_as_decimal(x) for k, x in data if k == g and x is not None]
                assert total == float(sum(values)) and average == float(sum(values)) / len(values)
                assert in_tenths == float((sum(values) / len(values)).quantize(Decimal("0.1"), ROUND_HALF_UP))
        table = spark.createDataFrame(data, "g int, x double")
        for x, got in table.select("x", exact(F.col("x"))).collect():
            assert got == (None if x is None else _as_decimal(x))
        day = W.partitionBy("g").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        assert {(r.g, r.s) for r in table.select("g", exact_sum(F.col("x"), day).alias("s")).collect()} == {(r.g, r.s) for r in found}
        pairs = table.select("x", F.lit(0.25).alias("y"))
        for x, got in pairs.select("x", combined_tenths([(1, F.col("x")), (-1, F.col("y"))], 1)).collect():
            exactly = None if x is None else (_as_decimal(x) - Decimal("0.25")).quantize(Decimal("0.1"), ROUND_HALF_UP)
            assert got == (None if x is None else float(exactly))
        for odd in (1e10, -1e10, 1e300, float("inf"), float("nan")):
            bad = spark.createDataFrame([(odd,), (1.0,), (1e-19,), (None,)], "x double")
            for question in (exact_sum, exact_avg, avg_tenths):
                with pytest.raises(Exception, match="Too large to be added"):
                    bad.agg(question(F.col("x"))).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_history_needs_one_exchange_and_no_window_over_rows(spark, tmp_path):
    """The rows are shuffled once; the only window orders the tails of blocks."""
    data = [(k, b, at, float(at)) for k in range(3) for b in range(4) for at in range(5)]
    spark.createDataFrame(data, "key int, block int, at int, value double").write.parquet(str(tmp_path / "t"))
    found = with_earlier(spark.read.parquet(str(tmp_path / "t")), "key", ["block"], ["at"], "value", 2)
    assert found.count() == 60
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Window [") == 1 and "collect_list(_tail" in final[final.index("Window [") :][:200]
    assert "ReusedExchange" in final or final.count("FileScan") <= 2


@pytest.fixture
def stored(spark, star, tmp_path):
    for name in ("fact", "dates", "locations"):
        getattr(star, name).write.parquet(str(tmp_path / name))
    return Star(*[spark.read.parquet(str(tmp_path / name)) for name in ("fact", "dates", "locations")])


@pytest.mark.parametrize("name", ["q9_daily", "q10_daily", "q11", "q12_daily"])
def test_daily_windows_and_the_sort_share_one_shuffle(stored, name):
    """Before, rows were shuffled for the window and again for the sort."""
    plan = QUESTIONS[name](stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("name", ["q9", "q10", "q10_daily"])
def test_values_are_worked_out_after_the_sort(stored, name):
    """Before, the pass that samples the sort's ranges worked them out as well."""
    plan = QUESTIONS[name](stored)._jdf.queryExecution().executedPlan().toString()
    above, below = plan[: plan.index("Exchange rangepartitioning")], plan[plan.index("Exchange rangepartitioning") :]
    column = "temp_change" if name == "q9" else "moving_avg_3hr"
    assert column in above and column not in below

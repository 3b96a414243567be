"""The thirteen questions asked of the hourly star.

Grouping and windows work on the dimension keys; names are attached afterwards, to
the smaller result where there is one. Dates and names are unique in their
dimensions, so grouping by key and by name is the same. Sort orders carry extra
columns at the end: they make the order total, and keep a range sort from sending
all rows of one frequent value to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from isobar.functions.exact import avg_tenths, combined_tenths, exact_sum, exact_total
from isobar.operators.neighbours import with_earlier
from isobar.operators.star import Star

_PLACE = ("location_name", "date_value")
_KEYS = ("location_id", "date_id")
_TEMP = "temperature_2m"

# ---------------------------------------------------------------- fixed values
FREEZING = 0
HIGH_WIND = 15
MILD = (10, 20)
HIGH_VARIANCE = 10
SAMPLE_ROWS = 10
# -----------------------------------------------------------------------------


def _first(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def _highest(name: str) -> Column:
    return F.col(name).desc_nulls_first()


def _readings(star: Star, *measures: str) -> DataFrame:
    return star.fact.select(*_KEYS, "hour", *measures)


def q1(star: Star) -> DataFrame:
    """A readable sample."""
    rows = star.name(_readings(star, _TEMP, "precipitation"))
    return (
        rows.select(*_PLACE, "hour", _TEMP, "precipitation")
        .orderBy(_first("location_name"), _first("hour"), _first("date_value"))
        .limit(SAMPLE_ROWS)
    )


def q2(star: Star) -> DataFrame:
    """Hours below freezing, coldest first."""
    cold = _readings(star, _TEMP).where(F.col(_TEMP) < FREEZING)
    return star.name(cold).select(*_PLACE, "hour", _TEMP).orderBy(
        _first(_TEMP), *map(_first, _PLACE), _first("hour")
    )


def q3(star: Star) -> DataFrame:
    """Hours of high wind, strongest first."""
    windy = _readings(star, "wind_speed_10m", _TEMP).where(F.col("wind_speed_10m") > HIGH_WIND)
    return star.name(windy).select(*_PLACE, "hour", "wind_speed_10m", _TEMP).orderBy(
        _highest("wind_speed_10m"), *map(_first, _PLACE), _first("hour")
    )


def q4(star: Star) -> DataFrame:
    """Weekend hours. With one fact folder per day, other days are never opened.

    Spark prunes folders at run time for filters it takes to be selective; a comparison
    is one, a bare flag is not.
    """
    weekends = F.broadcast(star.dates.where(F.col("is_weekend") >= F.lit(True)))
    rows = star.with_locations(_readings(star, _TEMP).join(weekends, "date_id"))
    return rows.select(*_PLACE, "day_of_week", "hour", _TEMP).orderBy(
        _first("location_name"), _first("hour"), _first("date_value")
    )


def q5(star: Star) -> DataFrame:
    """Average temperature per city and day, warmest first."""
    daily = star.fact.groupBy(*_KEYS).agg(
        F.count(F.lit(1)).alias("hours_recorded"), avg_tenths(F.col(_TEMP)).alias("avg_temp")
    )
    return star.name(daily).select(*_PLACE, "hours_recorded", "avg_temp").orderBy(
        _highest("avg_temp"), *map(_first, _PLACE)
    )


def _extremes(star: Star) -> DataFrame:
    daily = star.fact.groupBy(*_KEYS).agg(F.min(_TEMP).alias("min_temp"), F.max(_TEMP).alias("max_temp"))
    return daily.withColumn("temp_variance", F.col("max_temp") - F.col("min_temp"))


def q6(star: Star) -> DataFrame:
    """Lowest and highest temperature per city and day."""
    return star.name(_extremes(star)).select(*_PLACE, "min_temp", "max_temp", "temp_variance").orderBy(
        _highest("temp_variance"), *map(_first, _PLACE)
    )


def q7(star: Star) -> DataFrame:
    """Cities with any rain."""
    totals = star.fact.groupBy("location_id").agg(
        exact_sum(F.col("precipitation")).alias("total_precipitation")
    ).where("total_precipitation > 0")
    return star.with_locations(totals).select("location_name", "total_precipitation").orderBy(
        _highest("total_precipitation"), _first("location_name")
    )


def temperature_bucket(celsius: Column) -> Column:
    """A missing temperature counts as Hot: it fails both comparisons."""
    return (
        F.when(celsius < MILD[0], "Cold").when(celsius.between(*MILD), "Mild").otherwise("Hot")
    )


def q8(star: Star) -> DataFrame:
    """Hours per temperature bucket."""
    bucket = temperature_bucket(F.col(_TEMP)).alias("temp_category")
    counts = star.fact.groupBy(*_KEYS, bucket).agg(F.count(F.lit(1)).alias("hours_count"))
    return star.name(counts).select(*_PLACE, "temp_category", "hours_count").orderBy(
        _first("location_name"), _highest("hours_count"), _first("date_value"), _first("temp_category")
    )


def _over_history(star: Star, value: str, n: int) -> DataFrame:
    """Values of the rows before, over a location's whole history by hour, then date.

    The order by hour first makes (hour, decade) contiguous, so that is the block: at
    most 3,653 rows of a location, however much of the table the location holds, and
    24 blocks a decade to order across.
    """
    decade = F.call_function("div", F.col("date_id"), F.lit(100_000)).cast("int")
    rows = _readings(star, value).withColumn("_decade", decade)
    return with_earlier(rows, "location_id", ["hour", "_decade"], ["date_id"], value, n)


def _by_days(star: Star, value: str) -> DataFrame:
    """Named readings in ranges of places and days.

    A range holds a place's day whole, as a window over the day needs it, and the ranges are in the order of the result: the rows are
    shuffled once, before the window, and not again for the sort.
    """
    return star.name(_readings(star, value)).repartitionByRange(*map(_first, _PLACE))


def _day(*order: Column | str) -> WindowSpec:
    return W.partitionBy(*_PLACE, *_KEYS).orderBy(*order)


def _over_day(star: Star, value: str, n: int) -> DataFrame:
    lags = {f"before_{k}": F.lag(value, k).over(_day("hour")) for k in range(1, n + 1)}
    return _by_days(star, value).withColumns(lags)


def _by_place(star: Star, rows: DataFrame, *columns: Column | str) -> DataFrame:
    """Rows by place, day and hour. Columns are worked out after the sort, which evaluates what lies below it twice."""
    named = rows if set(_PLACE) <= set(rows.columns) else star.name(rows)
    return named.orderBy(*map(_first, _PLACE), _first("hour")).select(*_PLACE, "hour", *columns)


def _change(star: Star, rows: DataFrame) -> DataFrame:
    previous = F.col("before_1")
    change = combined_tenths([(1, F.col(_TEMP)), (-1, previous)], 1)
    return _by_place(star, rows, _TEMP, previous.alias("prev_hour_temp"), change.alias("temp_change"))


def q9(star: Star) -> DataFrame:
    """Change from the row before, ordered by hour over all of a city's days."""
    return _change(star, _over_history(star, _TEMP, 1))


def q9_daily(star: Star) -> DataFrame:
    """Change from the hour before, within each day."""
    return _change(star, _over_day(star, _TEMP, 1))


def _rolling(star: Star, rows: DataFrame) -> DataFrame:
    three = [F.col(_TEMP), F.col("before_1"), F.col("before_2")]
    average = combined_tenths(
        [(1, F.coalesce(value, F.lit(0.0))) for value in three], sum((value.isNotNull().cast("int") for value in three), F.lit(0))
    )
    return _by_place(star, rows, _TEMP, average.alias("moving_avg_3hr"))


def q10(star: Star) -> DataFrame:
    """Average over three rows, ordered by hour over all of a city's days."""
    return _rolling(star, _over_history(star, _TEMP, 2))


def q10_daily(star: Star) -> DataFrame:
    """Average over three hours, within each day."""
    return _rolling(star, _over_day(star, _TEMP, 2))


def q11(star: Star) -> DataFrame:
    """Hours of each day ranked from the hottest; a missing temperature ranks first."""
    ranked = _by_days(star, _TEMP).withColumn("heat_rank", F.rank().over(_day(_highest(_TEMP))))
    return ranked.select(*_PLACE, "hour", _TEMP, "heat_rank").orderBy(
        *map(_first, _PLACE), _first("heat_rank"), _first("hour")
    )


def q12(star: Star) -> DataFrame:
    """Rain up to and including each hour of day, summed over all of a city's days.

    Rows of one hour are ties and share one total, so the running sum needs only the
    24 hourly sums of a location. They are joined back to the rows.
    """
    hourly = star.fact.groupBy("location_id", "hour").agg(
        exact_total(F.col("precipitation")).alias("_total")
    )
    upto = W.partitionBy("location_id").orderBy("hour").rowsBetween(W.unboundedPreceding, W.currentRow)
    running = hourly.select(
        "location_id", "hour", F.sum("_total").over(upto).cast("double").alias("cumulative_precip")
    )
    rows = _readings(star, "precipitation").join(running, ["location_id", "hour"])
    return _by_place(star, rows, "precipitation", "cumulative_precip")


def q12_daily(star: Star) -> DataFrame:
    """Running rain total within each day."""
    day = _day("hour").rangeBetween(W.unboundedPreceding, W.currentRow)
    rows = _by_days(star, "precipitation").withColumn("cumulative_precip", exact_sum(F.col("precipitation"), day))
    return _by_place(star, rows, "precipitation", "cumulative_precip")


def q13(star: Star) -> DataFrame:
    """City days whose temperature varied by more than ten degrees."""
    varied = _extremes(star).where(F.col("temp_variance") > HIGH_VARIANCE)
    return star.name(varied).select(*_PLACE, "max_temp", "min_temp", "temp_variance").orderBy(
        _highest("temp_variance"), *map(_first, _PLACE)
    )


QUESTIONS = {
    "q1": q1, "q2": q2, "q3": q3, "q4": q4, "q5": q5, "q6": q6, "q7": q7, "q8": q8,
    "q9": q9, "q9_daily": q9_daily, "q10": q10, "q10_daily": q10_daily, "q11": q11,
    "q12": q12, "q12_daily": q12_daily, "q13": q13,
}

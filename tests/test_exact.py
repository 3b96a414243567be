"""Sums that count millionths in long arithmetic against sums of decimals."""

import random

from pyspark.sql import functions as F

from isobar.functions.exact import exact_avg, exact_sum, exact_total

_RANDOM = random.Random(5)
GROUPS = {
    "none": [],
    "missing": [None, None],
    "zero": [0.1, -0.1, -0.0],
    "negative": [-0.000001, -16.777216, None],
    "usual": [round(_RANDOM.uniform(-50, 50), 6) for _ in range(3000)],
    "finer": [0.1, 1 / 3, 0.0000001],
    "near the limit": [999_999_999.999999] * 9 + [4_503_599.0],
    "beyond the limit": [999_999_999.999999] * 40,
    "below": [-999_999_999.999999] * 40 + [0.3],
}


def frame(spark):
    cells = [(name, value) for name, values in GROUPS.items() for value in values]
    return spark.createDataFrame(cells, "name string, value double")


def test_sums_are_those_of_decimals(spark):
    value = F.col("value")
    found = frame(spark).groupBy("name").agg(
        exact_sum(value).alias("quick"), exact_total(value).cast("double").alias("slow"),
        exact_avg(value).alias("average"), F.count(value).alias("n"),
    ).collect()
    assert {row["name"] for row in found} == set(GROUPS) - {"none"}
    for row in found:
        assert repr(row["quick"]) == repr(row["slow"]), row
        assert row["average"] == (row["slow"] / row["n"] if row["n"] else None)


def test_usual_sums_need_no_decimal(spark):
    """Before, every group's total became a decimal of 36 digits first."""
    plan = frame(spark).groupBy("name").agg(exact_sum(F.col("value")))._jdf.queryExecution().optimizedPlan().toString()
    assert " / 1000000.0) ELSE " in plan

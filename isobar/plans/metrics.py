"""Governed metrics: declared once, computed by any dimension the model declares."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.functions.exact import avg_of_avgs, sum_of_sums

AGGREGATIONS = {
    "sum": sum_of_sums,
    "average": avg_of_avgs,
    "max": F.max,
}


@dataclass(frozen=True)
class Measure:
    name: str
    expr: str
    agg: str

    def column(self) -> Column:
        return AGGREGATIONS[self.agg](F.col(self.expr))


@dataclass(frozen=True)
class Metric:
    name: str
    label: str
    measure: str


@dataclass(frozen=True)
class SemanticModel:
    name: str
    table: str
    time_dimension: str
    entities: dict[str, str]
    dimensions: dict[str, str]
    measures: dict[str, Measure]


# ---------------------------------------------------------------- fixed values
DAILY_WEATHER = SemanticModel(
    name="sm_daily_weather_summary",
    table="mart_daily_weather_summary",
    time_dimension="summary_date",
    entities={"summary_id": "primary", "location_id": "foreign", "date_id": "foreign"},
    dimensions={"summary_date": "time", "location_name": "categorical", "is_weekend": "categorical"},
    measures={
        measure.name: measure
        for measure in (
            Measure("total_precipitation", "total_precipitation_mm", "sum"),
            Measure("avg_temperature", "avg_temp_c", "average"),
            Measure("max_wind_speed", "max_wind_speed_kmh", "max"),
        )
    },
)

METRICS = {
    metric.name: metric
    for metric in (
        Metric("average_daily_temperature", "Average Daily Temp (C)", "avg_temperature"),
        Metric("total_daily_precipitation", "Total Precipitation (mm)", "total_precipitation"),
        Metric("max_daily_wind_speed", "Max Wind Speed (km/h)", "max_wind_speed"),
    )
}
# -----------------------------------------------------------------------------

GRAINS = ("day", "week", "month", "quarter", "year")


def metric_query(
    mart: DataFrame,
    metrics: Iterable[str],
    group_by: Iterable[str] = (),
    grain: str = "day",
    where: Column | str | None = None,
    model: SemanticModel = DAILY_WEATHER,
) -> DataFrame:
    """Any metrics over any declared dimensions or entities, in one grouping pass."""
    names, groups = list(metrics), list(group_by)
    unknown = [name for name in names if name not in METRICS]
    if unknown:
        raise KeyError(f"Unknown metrics: {', '.join(unknown)}")
    undeclared = [g for g in groups if g not in model.dimensions and g not in model.entities]
    if undeclared:
        raise KeyError(f"Not a dimension of {model.name}: {', '.join(undeclared)}")
    if grain not in GRAINS:
        raise ValueError(f"Unknown time grain: {grain}")
    rows = mart if where is None else mart.where(where)
    keys = [
        F.date_trunc(grain, name).cast("date").alias(name)
        if name == model.time_dimension and grain != "day" else F.col(name)
        for name in groups
    ]
    values = [model.measures[METRICS[name].measure].column().alias(name) for name in names]
    return rows.groupBy(*keys).agg(*values)

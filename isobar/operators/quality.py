"""Checks over tables. Each returns its findings as a DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.operators.star import Star
from isobar.schemas import FACT_KEYS


def row_count(df: DataFrame, table: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(table).alias("table_name"), "row_count")


def null_counts(fact: DataFrame) -> DataFrame:
    """Row total, missing readings and rows without a dimension key, in one pass."""
    def missing(condition):
        return F.sum(F.when(condition, 1).otherwise(0))

    return fact.agg(
        F.count(F.lit(1)).alias("total_rows"),
        missing(F.col("temp_celsius").isNull()).alias("missing_temps"),
        missing(F.col("precipitation_mm").isNull()).alias("missing_precip"),
        missing(F.col("location_id").isNull() | F.col("date_id").isNull()).alias("orphaned_records"),
    )


def unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """Values that occur more than once; NULLs are not compared. Counts combine map-side."""
    present = reduce(lambda kept, name: kept.where(F.col(name).isNotNull()), columns, df)
    return present.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per column, one row each, from one pass over the table."""
    counted = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    pairs = F.array(
        *[F.struct(F.lit(name).alias("column_name"), F.col(name).alias("n_nulls")) for name in columns]
    )
    return counted.select(F.inline(pairs))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent, with the number of child rows that hold each.

    Child rows are counted per value before the join, so a value held by a third of
    the rows reaches it as one row.
    """
    values = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_records"))
    )
    return values.join(parent.select(F.col(parent_column).alias("value")), "value", "left_anti")


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Natural keys held by more than one row, across files."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


# Declared constraints of the star. The fact's key is its natural key packed, so its uniqueness covers both.
_FACT = "fact_weather_hourly"
_UNIQUE = {"dim_date": ("date_id", "date_value"), "dim_location": ("location_id", "location_name"), _FACT: ("fact_id",)}
_REQUIRED = {
    "dim_date": ("date_id", "date_value"),
    "dim_location": ("location_id", "location_name", "latitude", "longitude"),
    _FACT: ("fact_id", *FACT_KEYS),
}
_REFERENCES = {"dim_date": "date_id", "dim_location": "location_id"}


def star_constraints(star: Star) -> DataFrame:
    """Failing values per declared constraint of the star, zero where it holds.

    Plain Parquet enforces nothing, so keys, uniqueness, required columns and references are checked after a load. Every table is
    read once: its rows become (constrained column, value) pairs, those of the dimensions' keys once more as a mark
    that the fact may refer to them, and one grouping counts all pairs, map-side first. Whole numbers, all that the fact has, stay numbers;
    only the dimensions' other values are texts.
    """
    dimensions = {"dim_date": star.dates, "dim_location": star.locations}
    numbers = {"date_id", "location_id", "fact_id"}

    def pairs(table: str) -> DataFrame:
        cells = []
        for column in dict.fromkeys((*_UNIQUE[table], *_REQUIRED[table])):
            compared, seen = F.col(column), F.when(F.col(column).isNotNull(), 0)
            number = compared if column in numbers else seen if column not in _UNIQUE[table] else F.lit(None)
            text = compared.cast("string") if column in _UNIQUE[table] and column not in numbers else F.lit(None).cast("string")
            cells.append((f"{table}.{column}", number, text, 1, 0))
        column = _REFERENCES[table]
        cells.append((column, F.col(column), F.lit(None).cast("string"), 0, 1))
        structs = [
            F.struct(
                F.lit(item).alias("item"), number.cast("bigint").alias("number"), text.alias("text"),
                F.lit(n).cast("bigint").alias("n"), F.lit(mark).alias("parent"),
            )
            for item, number, text, n, mark in cells
        ]
        return dimensions[table].select(F.inline(F.array(*structs)))

    # A column that may repeat and refers to nothing is only looked at for missing values.
    compared = (*_UNIQUE[_FACT], *_REFERENCES.values())
    constrained = list(dict.fromkeys((*_UNIQUE[_FACT], *_REQUIRED[_FACT])))
    cells = [F.col(c) if c in compared else F.when(F.col(c).isNotNull(), 0) for c in constrained]
    fact = star.fact.select(*[cell.cast("bigint").alias(c) for c, cell in zip(constrained, cells)]).unpivot([], constrained, "item", "number")
    fact = fact.where(F.col("item").isin(*compared) | F.col("number").isNull()).select(
        "item", "number", F.lit(None).cast("string").alias("text"), F.lit(1).cast("bigint").alias("n"), F.lit(0).alias("parent")
    )
    counted = reduce(DataFrame.unionByName, map(pairs, dimensions), fact).groupBy("item", "number", "text").agg(
        F.sum("n").alias("n"), F.max("parent").alias("parent")
    )
    known = F.col("number").isNotNull() | F.col("text").isNotNull()
    failures = counted.groupBy("item").agg(
        F.count_if(known & (F.col("n") > 1)).alias("unique"),
        F.sum(F.when(~known, F.col("n")).otherwise(0)).alias("not_null"),
        F.count_if(known & (F.col("n") > 0) & (F.col("parent") == 0)).alias("foreign_key"),
    )
    checks = [(t, "unique", c) for t, columns in _UNIQUE.items() for c in columns]
    checks += [(t, "not_null", c) for t, columns in _REQUIRED.items() for c in columns]
    checks += [(_FACT, "foreign_key", c) for c in _REFERENCES.values()]
    declared = star.fact.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(*[F.lit(x).alias(n) for n, x in zip(("table_name", "constraint_type", "column_name"), check)]) for check in checks
    ])))
    # The fact's columns go by their bare names, which are shorter keys.
    item = F.when(F.col("table_name") == _FACT, F.col("column_name")).otherwise(F.concat_ws(".", "table_name", "column_name"))
    kind = F.col("constraint_type")
    found = F.when(kind == "unique", F.col("unique")).when(kind == "not_null", F.col("not_null")).otherwise(F.col("foreign_key"))
    return declared.join(failures, item == failures["item"], "left").select(
        "table_name", "constraint_type", "column_name", F.coalesce(found, F.lit(0)).cast("bigint").alias("n_failures")
    )


def proof_join(star: Star) -> DataFrame:
    """The newest rows under readable names."""
    return (
        star.name(star.fact)
        .select("date_value", "location_name", "hour", "temp_celsius", "wind_speed_kmh")
        .orderBy(F.col("date_value").desc(), F.col("location_name").asc_nulls_last(), "hour")
        .limit(15)
    )

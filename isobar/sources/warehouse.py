"""The warehouse folder: staging, dimensions, fact, mart and time spine."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar import schemas as S
from isobar.sources import snapshots
from isobar.sources.layout import (
    aligned, beside, children, drop_scratch, move_files, path_exists, read_parquet, restore, swap_in,
)

TABLES: dict[str, T.StructType] = {
    "raw_weather": S.RAW_WEATHER,
    "raw_weather_staging": S.GOLD,
    "dim_date": S.DIM_DATE,
    "dim_location": S.DIM_LOCATION,
    "fact_weather_hourly": S.FACT,
    "mart_daily_weather_summary": S.MART,
    "metricflow_time_spine": S.TIME_SPINE,
}

FACT_TABLE = "fact_weather_hourly"
# Folder column of the fact by grain: a day each, or a month each where dates are many and thin.
FACT_FOLDERS = {"day": "date_id", "month": "month_id"}


def with_fact_folder(fact: DataFrame, folder: str) -> DataFrame:
    if folder != FACT_FOLDERS["month"]:
        return fact
    return fact.withColumn(folder, F.call_function("div", F.col("date_id"), F.lit(100)).cast("int"))


@dataclass(frozen=True)
class Warehouse:
    """Tables as Parquet folders under one root; one writer at a time is assumed.

    The fact is published as snapshots: its folders change all at once. ``fact_grain``, ``day`` or ``month``, is how a new one is
    laid out. An existing one keeps its layout; asking for another is an error. The fact has gold's measure names however it was loaded.
    """

    spark: SparkSession
    root: str
    fact_grain: str | None = None

    @property
    def fact_folder(self) -> str:
        """Folder column of the fact, from the table itself where there is one."""
        asked = FACT_FOLDERS[self.fact_grain] if self.fact_grain else None
        path = self.path(FACT_TABLE)
        if snapshots.has_snapshots(self.spark, path):
            found = snapshots.keys_of(self.spark, path)[0]
            if asked and found != asked and not any(snapshots.folders(self.spark, path, [found])):
                found = asked  # an empty table can be laid out anew
        else:
            names = {name.split("=")[0] for name in children(self.spark, path) if "=" in name}
            found = next((folder for folder in FACT_FOLDERS.values() if folder in names), None)
        if found and asked and found != asked:
            raise ValueError(f"The fact at {path} is laid out by {found}, not by {asked}")
        return found or asked or FACT_FOLDERS["day"]

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def schema(self, table: str) -> T.StructType:
        return TABLES[table]

    def exists(self, table: str) -> bool:
        """Whether the table was written; a fact that was never published was not."""
        if not restore(self.spark, self.path(table)):
            return False
        return table != FACT_TABLE or snapshots.has_snapshots(self.spark, self.path(table)) or bool(self._plain_folders())

    def _plain_folders(self) -> list[str]:
        """Folders of a fact without snapshots."""
        return [n for n in children(self.spark, self.path(FACT_TABLE)) if n.split("=")[0] in FACT_FOLDERS.values()]

    def read(self, table: str) -> DataFrame:
        """A table by name; one that was never written reads as empty."""
        schema = self.schema(table)
        if not self.exists(table):
            return self.spark.createDataFrame([], schema)
        if table == FACT_TABLE:
            return self._read_fact(self.fact_folder).select(*schema.names)
        return read_parquet(self.spark, self.path(table), schema)

    def read_fact_folders(self, folder: str, values: Sequence[int]) -> DataFrame:
        """Fact rows of the given folders only; no file of the others is listed."""
        return self._read_fact(folder, list(values)).select(*self.schema(FACT_TABLE).names)

    def read_fact_days(self, days: Sequence[str]) -> DataFrame:
        """Fact rows of consecutive days, from the folders that can hold them."""
        if not days or not self.exists(FACT_TABLE):
            return self.spark.createDataFrame([], self.schema(FACT_TABLE))
        ids = [int(day.replace("-", "")) for day in days]
        folder = self.fact_folder
        values = ids if folder == FACT_FOLDERS["day"] else sorted({i // 100 for i in ids})
        return self.read_fact_folders(folder, values).where(F.col("date_id").between(ids[0], ids[-1]))

    def fact_schema(self, folder: str) -> T.StructType:
        schema = self.schema(FACT_TABLE)
        if folder in schema.names:
            return schema
        return T.StructType([*schema.fields, T.StructField(folder, T.IntegerType())])

    def _read_fact(self, folder: str, values: list[int] | None = None) -> DataFrame:
        path, schema = self.path(FACT_TABLE), self.fact_schema(folder)
        if snapshots.has_snapshots(self.spark, path):
            wanted = None if values is None else F.col(folder).isin([str(v) for v in values]) if values else F.lit(False)
            return snapshots.read(self.spark, path, schema, [folder], wanted)
        if values is None:
            return read_parquet(self.spark, path, schema)
        present = {f"{folder}={v}" for v in values} & set(self._plain_folders() if path_exists(self.spark, path) else [])
        return read_parquet(self.spark, path, schema, [f"{path}/{name}" for name in sorted(present)])

    def replace(self, table: str, df: DataFrame) -> None:
        """Overwrite a whole table.

        Spark's overwrite deletes first and computes second. The new table is written where nobody reads it
        and takes the old one's place when it is complete; ``df`` may read the table it replaces.
        """
        self.put(table, self.stage(table, df))

    def stage(self, table: str, df: DataFrame) -> str:
        """Write a whole table, unseen; returns where: a folder beside the present one, or the name of a version of the fact."""
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema(table).fields])
        self.exists(table)
        if table == FACT_TABLE:
            folder = self.fact_folder
            return snapshots.write_version(aligned(with_fact_folder(rows, folder), [folder]), self.path(table), [folder]).name
        incoming = beside(self.path(table), "incoming")
        rows.write.parquet(incoming)
        return incoming

    def put(self, table: str, staged: str) -> None:
        """Put a staged table in place."""
        if table == FACT_TABLE:
            snapshots.publish(self.spark, self.path(table), staged, [self.fact_folder], whole=True)
        else:
            swap_in(self.spark, staged, self.path(table))

    def append(self, table: str, df: DataFrame) -> int:
        """Add rows to a table; returns how many. Without rows no file is added.

        The rows are written once, beside the table, and their files moved into it.
        """
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema(table).fields])
        incoming = beside(self.path(table), "incoming")
        seen = Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(incoming)
        added = seen.get["rows"]
        if added:
            move_files(self.spark, incoming, self.path(table))
        drop_scratch(self.spark, incoming)
        return added

    def rebuild(self) -> None:
        """Drop and re-create staging, dimensions and fact as empty tables."""
        for table in ("raw_weather", "raw_weather_staging", FACT_TABLE, "dim_location", "dim_date"):
            self.replace(table, self.spark.createDataFrame([], self.schema(table)))

    def register(self) -> list[str]:
        """Name every table as a view, so SQL can be run on them; returns the names."""
        present = [table for table in TABLES if self.exists(table)]
        for table in present:
            self.read(table).createOrReplaceTempView(table)
        return present


def replace_staging(df: DataFrame, warehouse: Warehouse, table: str = "raw_weather") -> None:
    """Replace the staging table with ``df`` under the declared types."""
    warehouse.replace(table, df)

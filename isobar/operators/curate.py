"""Silver to gold: analyst names and derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.schemas import GOLD, MEASURES


def curate(silver: DataFrame) -> DataFrame:
    """A narrow projection: no shuffle, no filter, one gold row per silver row."""
    celsius = F.col("temp_celsius")
    renamed = silver.withColumnsRenamed(MEASURES)
    return renamed.withColumns(
        {
            "time": F.col("time").cast("timestamp_ntz"),
            "temp_fahrenheit": F.round(celsius * 9 / 5 + 32, 2),
            "is_freezing": F.coalesce(celsius <= 0, F.lit(False)),
        }
    ).select(*GOLD.names)


def row_counts(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Rows per layer, for reconciliation. No data column is read."""
    def tagged(df: DataFrame, layer: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(layer).alias("layer"), "row_count")

    return tagged(silver, "silver").unionByName(tagged(gold, "gold"))

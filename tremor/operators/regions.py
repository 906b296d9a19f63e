"""Region tagging and region filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.config import DEFAULT_REGION, OTHER_REGION, Region
from tremor.functions.classify import region_label


class MissingColumnsError(ValueError):
    """Input lacks columns an operator needs (checked on the schema, no job runs)."""


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise MissingColumnsError(f"required column(s) missing: {', '.join(missing)}")


def assign_region(
    df: DataFrame, region: Region = DEFAULT_REGION, other: str = OTHER_REGION, column: str = "region"
) -> DataFrame:
    """Tag each row with ``region.name`` when inside the closed box, else ``other``
    (rows with a missing coordinate included). Replaces an existing column."""
    require_columns(df, "latitude", "longitude")
    return df.withColumn(column, region_label(F.col("latitude"), F.col("longitude"), region, other))


def filter_region(df: DataFrame, name: str | None = DEFAULT_REGION.name, column: str = "region") -> DataFrame:
    """Rows of one region; a falsy ``name`` means no filter.

    An equality on a plain column, so it becomes a pushed Parquet filter, and
    partition pruning when the catalog is laid out by ``region``.
    """
    if not name:
        return df
    return df.filter(F.col(column) == F.lit(name))

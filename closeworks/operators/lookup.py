"""Joins to small sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_dimension(df: DataFrame, dim: DataFrame, on: str | list[str]) -> DataFrame:
    """Left join to a frame built from the configuration (one row per configured entry)."""
    return df.join(F.broadcast(dim), on, "left")

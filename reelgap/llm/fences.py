"""Filters on computed columns that stay where they are written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fenced(rows: DataFrame, condition: Column) -> DataFrame:
    """``rows`` where ``condition`` holds, tested on finished columns.

    A filter on a computed column is otherwise moved below the projections, with each column's expression in its place,
    also inside lambdas, where it would run once per element. A column of row numbers stops that.
    """
    return rows.withColumn("_fence", F.monotonically_increasing_id()).where(condition & (F.col("_fence") >= 0)).drop("_fence")

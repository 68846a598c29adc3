"""Joins of rows with facts about their keys, where a key may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it holds more than one in so many rows, so there are no more hot keys than that.
HOT = 10_000


def joined(rows: DataFrame, facts: DataFrame, keys: list[str], total: int, always_shuffle: bool = False) -> DataFrame:
    """``rows`` with the columns of ``facts``, which has a row for each key and the number of rows with it as ``n``; other rows go.

    ``total`` is the number of ``rows`` or more. Facts of hot keys are broadcast, HOT of them at most, so their rows
    stay where they are; the rest is joined by shuffle, with total / HOT rows a key at most, or however Spark does it
    best unless ``always_shuffle`` asks for one plan at all sizes.
    """
    is_hot = F.col("n") > F.lit(total // HOT)
    hot = F.broadcast(facts.where(is_hot))
    rest = facts.where(~is_hot).hint("merge") if always_shuffle else facts.where(~is_hot)
    return rows.join(hot, keys).unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(rest, keys))

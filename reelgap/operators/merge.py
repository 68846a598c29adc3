"""Merging of incoming rows into a keyed snapshot, with a rule for each column.

Parquet snapshots have no MERGE, so a merge is functional: reduce the incoming rows to one per key, join, and pick
each column by its rule. Reduction is a partial aggregate; the join is on the key.

Rules: ``overwrite`` (the last row wins whole, nulls included), ``new_then_old``, ``old_then_new``, ``always`` (the
last value), ``if_nonpositive`` and ``if_zero`` (numbers), ``if_blank`` (text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAST, FIRST = {"new_then_old", "always"}, {"old_then_new", "if_zero", "if_nonpositive", "if_blank"}


def _useful(rule: str, c: Column) -> Column:
    """Which incoming values can replace anything."""
    if rule == "if_nonpositive":
        return c > 0
    if rule == "if_zero":
        return c != 0
    if rule == "if_blank":
        return c != ""
    return c.isNotNull()


def reduce_batch(incoming: DataFrame, keys: list[str], rules: dict[str, str], order: str) -> DataFrame:
    """One row per key: for ``overwrite`` columns the last row's, else each column's last or first useful value."""
    whole = [c for c, r in rules.items() if r == "overwrite"]
    picks = [F.max_by(F.struct(*whole), order).alias("_last")] if whole else []
    for c, rule in rules.items():
        if rule in LAST:
            picks.append(F.max_by(c, F.when(_useful(rule, F.col(c)), F.col(order))).alias(c))
        elif rule in FIRST:
            picks.append(F.min_by(c, F.when(_useful(rule, F.col(c)), F.col(order))).alias(c))
    rows = incoming.groupBy(*keys).agg(*(picks or [F.count(F.lit(1)).alias("_n")]))
    return rows.select(*keys, *[(F.col("_last")[c] if c in whole else F.col(c)).alias(c) for c in rules])


def pick(rule: str, old: Column, new: Column, arrived: Column) -> Column:
    if rule in ("overwrite", "always"):
        return F.when(arrived, new).otherwise(old)
    if rule == "new_then_old":
        return F.coalesce(new, old)
    if rule == "old_then_new":
        return F.coalesce(old, new)
    zero = F.coalesce(old, F.lit(0))
    if rule == "if_nonpositive":
        return F.when(new.isNotNull() & (zero <= 0), new).otherwise(old)
    if rule == "if_zero":
        return F.when(zero == 0, F.coalesce(new, old)).otherwise(old)
    if rule == "if_blank":
        return F.when((F.coalesce(new, F.lit("")) != "") & (F.coalesce(old, F.lit("")) == ""), new).otherwise(old)
    raise ValueError(f"no such rule: {rule}")


def merge(existing: DataFrame, incoming: DataFrame, keys: list[str], rules: dict[str, str], order: str, insert: bool = True) -> DataFrame:
    """``existing`` with ``incoming`` merged in; columns without a rule keep what they have, null in inserted rows.

    ``order`` is the incoming rows' place in their batch. Without ``insert``, keys that aren't there are ignored.
    """
    e = existing.select([F.col(c).alias(f"_e_{c}") for c in existing.columns] + [F.lit(True).alias("_there")])
    n = reduce_batch(incoming, keys, rules, order).select([F.col(c).alias(f"_n_{c}") for c in [*keys, *rules]] + [F.lit(True).alias("_arrived")])
    on = [F.col(f"_e_{k}") == F.col(f"_n_{k}") for k in keys]
    rows = e.join(n, on, "full_outer" if insert else "left")
    arrived = F.col("_arrived").isNotNull()
    out = []
    for c in existing.columns:
        if c in keys:
            out.append(F.coalesce(f"_e_{c}", f"_n_{c}").alias(c))
        elif c in rules:
            inserted = F.col("_there").isNull()
            out.append(F.when(inserted, F.col(f"_n_{c}")).otherwise(pick(rules[c], F.col(f"_e_{c}"), F.col(f"_n_{c}"), arrived)).alias(c))
        else:
            out.append(F.col(f"_e_{c}").alias(c))
    return rows.select(*out)


def latest_rates(existing: DataFrame, incoming: DataFrame, order: str) -> DataFrame:
    """Exchange rates: the incoming rate and time win."""
    return merge(existing, incoming, ["rate_date", "from_currency", "to_currency"], {"rate": "overwrite", "fetched_at": "overwrite"}, order)


def merge_columns(df: DataFrame, source: str, target: str) -> DataFrame:
    """``source`` moved into ``target`` where that is zero or null, and dropped."""
    zero = F.lit(0)
    moved = F.coalesce(F.nullif(F.col(target), zero), F.nullif(F.col(source), zero), zero)
    return df.withColumn(target, F.when(F.coalesce(F.col(source), zero) != 0, moved).otherwise(F.col(target))).drop(source)


def default_language(df: DataFrame) -> DataFrame:
    return df.withColumn("language", F.when(F.coalesce(F.col("language"), F.lit("")) == "", "Unknown").otherwise(F.col("language")))


# The policies by target.
CAST_FROM_FILES = {c: "new_then_old" for c in ("language", "genre", "director", "rating", "votes", "runtime", "role_position")}
CAST_FROM_PAGES = {c: "old_then_new" for c in ("language", "genre", "director", "character_name")} | {"page_url": "always"}
FILMS_FROM_SOURCE1 = {"revenue": "if_nonpositive", "budget": "if_nonpositive", "runtime": "if_zero", "rating_10": "if_zero", "genre": "if_blank", "status": "if_blank"}
FILMS_FROM_OTHERS = {"revenue": "if_zero", "budget": "if_zero"}

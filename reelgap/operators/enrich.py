"""Country, indicator, event and exchange-rate lookups.

Every lookup goes over its distinct keys and joins back; small fixed tables are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgap.functions import clean, extract, values


def country_of_language(df: DataFrame, column: str) -> DataFrame:
    """iso and country of a language code or name (fixed table of under 100 rows)."""
    known = df.sparkSession.createDataFrame(values.resolver(), "_k string, iso string, country string")
    return df.withColumn("_k", F.lower(clean.strip(F.col(column)))).join(F.broadcast(known), "_k", "left").drop("_k")


def country_of_name(df: DataFrame, column: str) -> DataFrame:
    """iso and country of a country's name: equal, else contained either way; the longest known name, then the smallest code."""
    name = F.lower(clean.strip(F.col(column)))
    best = F.lit(None).cast("struct<rank:int,length:int,iso:string,country:string>")
    choices = []
    for iso, country in values.countries():
        low = country.lower()
        rank = F.when(name == low, 2).when(name.contains(low) | F.lit(low).contains(name), 1)
        choices.append(F.when(rank.isNotNull(), F.struct(rank.alias("rank"), F.lit(len(country)).alias("length"), F.lit(iso).alias("iso"), F.lit(country).alias("country"))))
    ordered = F.array_sort(F.filter(F.array(*choices), lambda x: x.isNotNull()), lambda a, b: F.when(a["rank"] != b["rank"], b["rank"] - a["rank"]).when(a["length"] != b["length"], b["length"] - a["length"]).when(a["iso"] < b["iso"], -1).otherwise(1))
    best = F.get(ordered, 0)
    return df.withColumn("_best", best).withColumn("iso", F.col("_best.iso")).withColumn("country", F.col("_best.country")).drop("_best")


def indicators(responses: DataFrame) -> DataFrame:
    """(iso, year, gdp_usd_billions, inflation_rate_pct) from (iso, year, indicator, body) responses."""
    value = extract.indicator_value(F.col("body"))
    rows = responses.withColumn("value", F.when(F.col("indicator") == "gdp", clean.scaled_indicator(value, 1e9)).otherwise(clean.scaled_indicator(value, 1.0)))
    return rows.groupBy("iso", "year").agg(F.max(F.when(F.col("indicator") == "gdp", F.col("value"))).alias("gdp_usd_billions"), F.max(F.when(F.col("indicator") == "inflation", F.col("value"))).alias("inflation_rate_pct"))


def enrich(df: DataFrame, date: str, language: str | None, country: str | None, indicator_rows: DataFrame | None, event_rows: DataFrame | None) -> DataFrame:
    """``df`` with five columns: two indicators of country and year, and the event of day and country.

    An explicit country goes before the language's. Indicators need a positive year, events a full date. Lookups not
    given leave their columns null; columns of these names are replaced.
    """
    names = ["gdp_usd_billions", "inflation_rate_pct", "release_event_type", "release_event_name", "release_event_detail"]
    taken = {c: f"_in_{c}" for c in ("iso", "country") if c in df.columns}  # the lookups give columns of these names
    rows = df.drop(*names).withColumnsRenamed(taken)
    country, language = taken.get(country, country), taken.get(language, language)
    by_name = country_of_name(rows, country).withColumnsRenamed({"iso": "_i1", "country": "_c1"}) if country else rows.withColumn("_i1", F.lit(None).cast("string")).withColumn("_c1", F.lit(None).cast("string"))
    both = country_of_language(by_name, language).withColumnsRenamed({"iso": "_i2", "country": "_c2"}) if language else by_name.withColumn("_i2", F.lit(None).cast("string")).withColumn("_c2", F.lit(None).cast("string"))
    year = F.substring(clean.strip(F.col(date)), 1, 4).try_cast("int")
    rows = both.withColumn("_iso", F.coalesce("_i1", "_i2")).withColumn("_country", F.coalesce("_c1", "_c2")).withColumn("_year", F.when(year > 0, year)).withColumn("_day", F.when(clean.strip(F.col(date)).rlike(r"^\d{4}-\d{2}-\d{2}$"), clean.strip(F.col(date))))
    if indicator_rows is not None:
        rows = rows.join(indicators(indicator_rows).withColumnsRenamed({"iso": "_iso", "year": "_year"}), ["_iso", "_year"], "left")
    else:
        rows = rows.withColumn(names[0], F.lit(None).cast("double")).withColumn(names[1], F.lit(None).cast("double"))
    if event_rows is not None:
        e = event_rows.select(F.col("date").alias("_day"), F.col("country").alias("_country"), extract.event(F.col("body")).alias("_e")).dropDuplicates(["_day", "_country"])
        rows = rows.join(e, ["_day", "_country"], "left").select("*", *[F.col(f"_e.{n.removeprefix('release_')}").alias(n) for n in names[2:]]).drop("_e")
    else:
        for n in names[2:]:
            rows = rows.withColumn(n, F.lit(None).cast("string"))
    return rows.select(*[F.col(taken.get(c, c)).alias(c) for c in df.columns if c not in names], *names)


def with_rate(df: DataFrame, date: str, rates: DataFrame, as_of: Column, source: str = "INR", target: str = "USD") -> DataFrame:
    """``rate`` of the day that holds for each row; the latest fetched of several."""
    pair = rates.where((F.col("from_currency") == source) & (F.col("to_currency") == target))
    pair = pair.groupBy(F.col("rate_date").alias("_rate_date")).agg(F.max(F.struct("fetched_at", "rate"))["rate"].alias("rate"))
    return df.withColumn("_rate_date", clean.rate_date(F.col(date), as_of)).join(pair, "_rate_date", "left").drop("_rate_date")


def new_rates(fetched: DataFrame, existing: DataFrame) -> DataFrame:
    """Fetched rates whose day and currencies are not stored yet."""
    return fetched.join(existing.select("rate_date", "from_currency", "to_currency"), ["rate_date", "from_currency", "to_currency"], "left_anti")


def resolver_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(values.resolver(), "key string, iso string, country string")

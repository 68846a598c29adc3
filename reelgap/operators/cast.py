"""The actor-by-film table: unpivoting, language fill and filmographies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgap.functions import clean
from reelgap.operators.columns import CastHeaders


def unpivot(df: DataFrame, actors: list[str], keep: list[Column]) -> DataFrame:
    """A row for each actor column with a name; role_position counts all actor columns from one."""
    rows = df.select(*keep, F.posexplode(F.array(*[clean.blank_to_null(F.col(f"`{a}`").cast("string")) for a in actors])).alias("_pos", "actor_name"))
    return rows.where("actor_name is not null").withColumn("role_position", F.col("_pos") + 1).drop("_pos")


def cast_rows(df: DataFrame, headers: CastHeaders, order: str) -> DataFrame:
    """Rows for the cast table from a wide file; rows without a film or a year are left out."""
    get = lambda f: F.col(f"`{headers.fields[f]}`").cast("string") if f in headers.fields else F.lit(None).cast("string")
    keep = [
        clean.blank_to_null(get("movie")).alias("movie_name"), clean.normalize_year(get("year")).alias("release_date"), clean.blank_to_null(get("language")).alias("language"),
        clean.blank_to_null(get("genre")).alias("genre"), clean.blank_to_null(get("director")).alias("director"), clean.number(get("rating")).alias("rating"),
        clean.number(get("votes")).alias("votes"), clean.runtime_text(get("runtime")).alias("runtime"), F.col(order),
    ]
    return unpivot(df, headers.actors, keep).where("movie_name is not null and release_date is not null")


def fill_language(cast: DataFrame, films: DataFrame) -> DataFrame:
    """Null languages of ``cast`` from films of the same name and year; the smallest of several."""
    key = lambda c: F.lower(clean.strip(F.col(c)))
    known = films.where(~F.coalesce("language", F.lit("")).isin("", "Unknown"))
    known = known.groupBy(key("movie_name").alias("_k"), clean.year_of(F.col("release_date")).alias("_y")).agg(F.min("language").alias("_language"))
    rows = cast.withColumn("_k", key("movie_name")).withColumn("_y", clean.year_of(F.col("release_date")))
    return rows.join(known, ["_k", "_y"], "left").withColumn("language", F.coalesce("language", "_language")).drop("_k", "_y", "_language")


def filmography(cast: DataFrame, actor: str, up_to: str | None = None) -> DataFrame:
    """An actor's films by date and name, up to and including a year; new_year marks the first film of each."""
    from pyspark.sql import Window

    rows = cast.where(F.lower(clean.strip(F.col("actor_name"))) == actor.strip().lower())
    if up_to is not None:
        rows = rows.where(clean.year_of(F.col("release_date")) <= up_to)
    year = clean.year_of(F.col("release_date"))
    before = F.lag(year).over(Window.partitionBy("actor_name").orderBy("release_date", "movie_name"))
    return rows.withColumn("new_year", ~year.eqNullSafe(before)).orderBy("release_date", "movie_name")


def filmography_counts(cast: DataFrame) -> DataFrame:
    """Films of each actor: how many, and their names by date and name."""
    films = F.array_sort(F.collect_list(F.struct("release_date", "movie_name")))
    return cast.groupBy("actor_name").agg(F.count(F.lit(1)).alias("films"), F.transform(films, lambda f: f["movie_name"]).alias("names"))

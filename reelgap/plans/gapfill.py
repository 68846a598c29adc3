"""Filling missing revenue, budget and details of films from fetched pages, source by source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgap.functions import clean, extract, values
from reelgap.operators import enrich, match, merge


def movie_years(films: DataFrame) -> DataFrame:
    """Each name and year with its earliest date, as text."""
    rows = films.where(F.col("release_date").isNotNull() & (F.length("release_date") >= 4))
    rows = rows.groupBy("movie_name", clean.year_of(F.col("release_date")).alias("year")).agg(F.min("release_date").alias("release_date"))
    return rows.where(F.col("movie_name").isNotNull() & F.col("year").rlike(r"^\d{4}$"))


def in_order(years: DataFrame) -> DataFrame:
    """By year, then name, as code points compare."""
    return years.orderBy("year", "movie_name")


def missing(films: DataFrame, indian_only: bool = False) -> DataFrame:
    """Names and years from 1980 on of films without revenue or budget."""
    lacks = lambda c: F.col(c).isNull() | (F.col(c) == 0)
    rows = films.where((clean.year_of(F.col("release_date")) >= "1980") & (lacks("revenue") | lacks("budget")))
    if indian_only:
        rows = rows.where(F.lower("language").isin(values.INDIAN_FILM_LANGUAGES))
    return movie_years(rows)


def apply(films: DataFrame, updates: DataFrame, rules: dict[str, str], order: str = "ord") -> DataFrame:
    """``films`` with (movie_name, year, measures) updates, in every row of the name and year."""
    keyed = films.withColumn("year", clean.year_of(F.col("release_date")))
    reduced = merge.reduce_batch(updates, ["movie_name", "year"], rules, order)
    reduced = reduced.select("movie_name", "year", *[F.col(c).alias(f"_n_{c}") for c in rules], F.lit(True).alias("_arrived"))
    rows = keyed.join(reduced, ["movie_name", "year"], "left")
    arrived = F.col("_arrived").isNotNull()
    return rows.select(*[(merge.pick(rules[c], F.col(c), F.col(f"_n_{c}").cast(films.schema[c].dataType), arrived).alias(c) if c in rules else F.col(c)) for c in films.columns])


def source1_updates(films: DataFrame, slugs: DataFrame, pages: DataFrame, rates: DataFrame, as_of: Column, threshold: float = 0.70) -> DataFrame:
    """What detail pages (slug, body) offer, matched by name within the year; amounts are converted on the film's day."""
    wanted = movie_years(films)
    pairs = match.best_by_name(slugs.where("year is not null"), wanted, "name", "movie_name", ["year"], 0.5, threshold, ["slug", "year", "ord"])
    details = pages.select("slug", *[c.alias(n) for n, c in extract.detail_page(F.col("body"), as_of).items()])
    rows = pairs.join(details, "slug").join(wanted, ["movie_name", "year"])
    rows = enrich.with_rate(rows, "release_date", rates, as_of)
    return rows.select("movie_name", "year", "ord", clean.crore_to_usd(F.col("worldwide_crore"), F.col("rate")).alias("revenue"), clean.crore_to_usd(F.col("budget_crore"), F.col("rate")).alias("budget"), "runtime", F.col("rating").alias("rating_10"), "genre", "status")


def source1(films: DataFrame, slugs: DataFrame, pages: DataFrame, rates: DataFrame, as_of: Column, threshold: float = 0.70) -> DataFrame:
    """``films`` with what source 1 offers."""
    rows = source1_updates(films, slugs, pages, rates, as_of, threshold)
    return apply(films, rows, {c: r for c, r in merge.FILMS_FROM_SOURCE1.items() if c in films.columns})


def _candidates(wanted: DataFrame, candidates: DataFrame, threshold: float) -> DataFrame:
    """The best candidate (movie_name, year, href) of each searched film; the first of equals."""
    c = candidates.withColumnRenamed("year", "c_year").withColumnRenamed("name", "c_name")
    rows = wanted.join(c, ["movie_name", "release_date"]).where(match.compatible_years(F.col("year"), F.col("c_year")))
    score = match.sim.edit_similarity(clean.normalize_name(F.col("movie_name")), clean.normalize_name(F.col("c_name")), 0.5)
    return match.top_one(rows.withColumn("score", score).where(F.col("score") >= threshold), ["movie_name", "year"], F.desc("score"), F.asc("ord"))


def source2_updates(films: DataFrame, candidates: DataFrame, pages: DataFrame, threshold: float = 0.70) -> DataFrame:
    """What dollar pages (href, body) offer, of the best search results (movie_name, release_date, ord, href, name, year)."""
    best = _candidates(missing(films), candidates, threshold)
    found = pages.select("href", *[c.alias(n) for n, c in extract.source2_page(F.col("body")).items()])
    return best.join(found, "href").select("movie_name", "year", "ord", F.col("revenue_usd").alias("revenue"), F.col("budget_usd").alias("budget"))


def source2(films: DataFrame, candidates: DataFrame, pages: DataFrame, threshold: float = 0.70) -> DataFrame:
    """``films`` with what source 2 offers."""
    return apply(films, source2_updates(films, candidates, pages, threshold), merge.FILMS_FROM_OTHERS)


def source3_updates(films: DataFrame, candidates: DataFrame, pages: DataFrame, rates: DataFrame, as_of: Column, threshold: float = 0.70) -> DataFrame:
    """What rupee articles (href, body) offer, for films in Indian languages only."""
    best = _candidates(missing(films, indian_only=True), candidates, threshold)
    found = pages.select("href", *[c.alias(n) for n, c in extract.source3_page(F.col("body")).items()])
    rows = enrich.with_rate(best.join(found, "href"), "release_date", rates, as_of)
    return rows.select("movie_name", "year", "ord", clean.crore_to_usd(F.col("worldwide_crore"), F.col("rate")).alias("revenue"), clean.crore_to_usd(F.col("budget_crore"), F.col("rate")).alias("budget"))


def source3(films: DataFrame, candidates: DataFrame, pages: DataFrame, rates: DataFrame, as_of: Column, threshold: float = 0.70) -> DataFrame:
    """``films`` with what source 3 offers."""
    return apply(films, source3_updates(films, candidates, pages, rates, as_of, threshold), merge.FILMS_FROM_OTHERS)


def search_text(name: Column, year: Column) -> Column:
    """A search for a film as part of a URL."""
    return F.url_encode(F.concat_ws(" ", name, year))

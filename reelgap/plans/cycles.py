"""Whole cycles over the store: fill gaps from fetched pages source by source, and import actors' filmographies.

A cycle takes what has been fetched as tables, runs once, writes what changed, and returns counters. Waiting between
requests and repeating cycles are the fetcher's and the scheduler's part; a repeated cycle changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgap.functions import clean
from reelgap.operators import enrich, match, merge, profile
from reelgap.plans import gapfill, imports
from reelgap.plans.imports import Settings
from reelgap.sources import pages
from reelgap.sources.store import CAST, FILMS, RATES, Store

FILM_KEYS = ["movie_name", "release_date", "language"]


def upkeep(films: DataFrame, legacy: dict[str, str] | None = None, aliases: dict[str, str] | None = None) -> DataFrame:
    """``films`` in the current shape: legacy columns renamed, alias columns merged and dropped, crawled columns added, one row per key.

    Language is part of the key: a blank one is Unknown, and rows that then meet become one, with the first useful value
    of each column.
    """
    for old, new in (legacy or {}).items():
        films = profile.rename_legacy(films, old, new)
    for source, target in (aliases or {}).items():
        if source in films.columns and target in films.columns:
            films = merge.merge_columns(films, source, target)
    films = profile.evolve(films, profile.CRAWLED_FILM_COLUMNS)
    films = merge.default_language(films)
    order = F.struct(*[F.col(c) for c in films.columns])
    rest = [c for c in films.columns if c not in FILM_KEYS]
    useful = lambda c: (F.col(c) != 0) if profile.is_numeric(films.schema[c].dataType) else clean.meaningful(F.col(c).cast("string"))
    picked = [F.coalesce(F.min_by(c, F.when(useful(c), order)), F.min(c)).alias(c) for c in rest]
    return films.groupBy(*FILM_KEYS).agg(*(picked or [F.count(F.lit(1)).alias("_n")])).select(*films.columns)


def counters(before: DataFrame, after: DataFrame, offered: DataFrame) -> dict[str, int]:
    """What a source did: films it ``offered`` (movie_name, year, measures), those with data, rows that they match, rows that changed."""
    has = F.lit(False)
    for c in offered.columns:
        if c not in ("movie_name", "year", "ord"):
            has = has | F.col(c).isNotNull()
    got = offered.agg(F.count(F.lit(1)).alias("offered"), F.count_if(has).alias("with_data")).first()
    names = offered.where(has).select("movie_name", "year").distinct()
    matched = before.withColumn("year", clean.year_of(F.col("release_date"))).join(names, ["movie_name", "year"], "left_semi").count()
    changed = after.exceptAll(before).count()
    return {"offered": got.offered, "no_data": got.offered - got.with_data, "matched_rows": matched, "changed_rows": changed}


def fill_gaps(store: Store, fetched: dict[str, DataFrame], as_of: Column, settings: Settings | None = None) -> dict[str, dict[str, int]]:
    """One gap-filling cycle over ``films``: each source in order, only for what the ones before it left open.

    ``fetched`` may have slugs and detail_pages (source 1), candidates2 and pages2, candidates3 and pages3, and rates;
    a source without its tables is left out. New rates are stored, films are written once, and each source's counters
    are returned by its name.
    """
    s = settings or Settings()
    films = upkeep(store.read("films", FILMS))
    rates = store.read("rates", RATES)
    if "rates" in fetched:
        fresh = enrich.new_rates(fetched["rates"], rates)
        if not fresh.isEmpty():
            rates = merge.latest_rates(rates, fresh, "fetched_at")
            store.write("rates", rates)
            rates = store.read("rates")
    done = {}
    steps = {
        "source1": (("slugs", "detail_pages"), lambda f: gapfill.source1_updates(f, fetched["slugs"], fetched["detail_pages"], rates, as_of, s.match_threshold), merge.FILMS_FROM_SOURCE1),
        "source2": (("candidates2", "pages2"), lambda f: gapfill.source2_updates(f, fetched["candidates2"], fetched["pages2"], s.match_threshold), merge.FILMS_FROM_OTHERS),
        "source3": (("candidates3", "pages3"), lambda f: gapfill.source3_updates(f, fetched["candidates3"], fetched["pages3"], rates, as_of, s.match_threshold), merge.FILMS_FROM_OTHERS),
    }
    for name, (needs, updates, rules) in steps.items():
        if all(n in fetched for n in needs):
            offered = updates(films)
            after = gapfill.apply(films, offered, {c: r for c, r in rules.items() if c in films.columns})
            done[name] = counters(films, after, offered)
            films = after
    store.write("films", films)
    return done


def actor_work(actors: DataFrame, known_pages: DataFrame, base: str, threshold: float = 0.75) -> DataFrame:
    """(actor_name, url, typo_url) of each actor: the known page (slug, url) of about that name, else the page of the name itself; and of its usual misspelling."""
    slugs = known_pages.select(clean.slug_name(F.col("slug")).alias("slug_name"), "url")
    best = match.best_by_name(actors.select("actor_name"), slugs.groupBy("slug_name").agg(F.min("url").alias("_u")), "actor_name", "slug_name", [], 0.4, threshold, ["actor_name"])
    found = best.join(slugs.groupBy("slug_name").agg(F.min("url").alias("known")), "slug_name").select("actor_name", "known")
    page = lambda slug: F.concat(F.lit(f"{base}/news/List_Of_All_"), slug, F.lit("_Movies"))
    slug = clean.filmography_slug(F.col("actor_name"))
    return actors.select("actor_name").join(found, "actor_name", "left").select("actor_name", F.coalesce("known", page(slug)).alias("url"), page(clean.typo_slug(slug)).alias("typo_url"))


def filmographies(work: DataFrame, fetched: DataFrame) -> DataFrame:
    """Films of each actor's page, or where that gives none, of the page of the misspelt name; ``fetched`` is (url, body)."""
    first = pages.filmography_entries(work.join(fetched, "url").select("url", "actor_name", "body"))
    rest = work.join(first.select("actor_name").distinct(), "actor_name", "left_anti").where("typo_url is not null and typo_url <> url")
    second = rest.drop("url").withColumnRenamed("typo_url", "url").join(fetched, "url").select("url", "actor_name", "body")
    return first.unionByName(pages.filmography_entries(second))


def import_actors(store: Store, known_pages: DataFrame, fetched: DataFrame, base: str, settings: Settings | None = None) -> dict[str, int]:
    """One cycle over all actors of ``cast``: find their pages, merge the films there into ``cast``, and count."""
    s = settings or Settings()
    cast = store.read("cast", CAST)
    work = actor_work(cast.where("actor_name is not null").select("actor_name").distinct(), known_pages, base, s.actor_threshold)
    entries = filmographies(work, fetched).where("movie_name is not null and release_date is not null")
    imports.merge_entries(store, entries)
    n = entries.agg(F.count_distinct("actor_name").alias("actors"), F.count(F.lit(1)).alias("entries")).first()
    actors = work.count()
    return {"actors": actors, "found": n.actors, "not_found": actors - n.actors, "entries": n.entries, "rows_before": cast.count(), "rows_after": store.read("cast").count()}

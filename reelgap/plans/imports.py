"""Imports of film and cast files, and of filmography pages, into the store; queries over it."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgap.functions import clean
from reelgap.operators import cast, columns, enrich, match, merge, profile
from reelgap.sources import csv_files, pages
from reelgap.sources.store import CAST, FILMS, Store


@dataclass
class Settings:
    """Thresholds and switches, with the source system's defaults; ``fuzzy_max_pairs`` of None lifts its limit."""

    fuzzy_auto: float = 0.93
    fuzzy_warn: float = 0.75
    fuzzy_max_pairs: int | None = 50_000
    match_threshold: float = 0.70
    actor_threshold: float = 0.75
    enrichment: bool = False

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Settings:
        """From ``name = value`` lines; # begins a comment, ``none`` is None, other names are ignored, and what is missing keeps its default."""
        known = {f.name: f for f in fields(cls)}
        given = {}
        for row in spark.read.text(path).collect():
            name, found, value = (x.strip() for x in row.value.partition("#")[0].partition("="))
            if found and name in known:
                kind = type(known[name].default)
                given[name] = None if value.lower() == "none" else value.lower() == "true" if kind is bool else kind(value)
        return cls(**given)


def import_csv(spark: SparkSession, store: Store, path: str, settings: Settings | None = None, indicators: DataFrame | None = None, events: DataFrame | None = None) -> DataFrame:
    """Merge a film file into the table ``films``; one row of counters: processed, merged, skipped."""
    s = settings or Settings()
    raw = columns.transform(csv_files.read(spark, path)).persist()  # read once for profile, counters, names and merge
    headers = [c for c in raw.columns if c not in (csv_files.ORDER, csv_files.FILE)]
    if s.enrichment and "release_date" in headers:
        language = next((h for h in headers if h.lower() in ("original_language", "language")), None)
        raw = enrich.enrich(raw, "release_date", language, columns.country_header(headers), indicators, events)
        headers = [c for c in raw.columns if c not in (csv_files.ORDER, csv_files.FILE)]
    mapped = columns.mapping(headers)
    rows = columns.select_mapped(raw, mapped, [csv_files.ORDER])
    for key in columns.KEYS:
        if key not in rows.columns:
            rows = rows.withColumn(key, F.lit(None).cast("string"))
    existing = store.read("films", FILMS)
    data = [c for c in mapped if c not in columns.KEYS]
    fresh = [c for c in data if c not in existing.columns]
    kinds = profile.infer(rows, fresh) if fresh else {}
    numeric = {c: kinds[c] == profile.NUMERIC if c in kinds else profile.is_numeric(existing.schema[c].dataType) for c in data}
    existing = profile.evolve(existing, kinds)
    rows = rows.select(*[clean.blank_to_null(F.col(k)).alias(k) for k in columns.KEYS], *[clean.sanitize(F.col(c).cast("string"), numeric[c]).alias(c) for c in data], csv_files.ORDER)
    counts = rows.agg(F.count_if(F.col("movie_name").isNotNull() & F.col("release_date").isNotNull()).alias("processed"), F.count_if(F.col("movie_name").isNull() | F.col("release_date").isNull()).alias("skipped"))
    rows = merge.default_language(rows.where("movie_name is not null and release_date is not null"))
    names = match.canonical_names(rows, existing, csv_files.ORDER, s.fuzzy_warn, s.fuzzy_auto, s.fuzzy_max_pairs)
    rows = match.rename_canonical(rows, names).persist()
    merged = rows.agg(F.count_if("merged").alias("merged"))
    absent = [f for f in existing.schema.fields if f.name not in columns.KEYS and f.name not in data]
    out = merge.merge(existing, rows.drop("merged"), columns.KEYS, {c: "overwrite" for c in data}, csv_files.ORDER)
    if absent:  # defaults for rows that this file adds without these columns
        old = existing.select(*columns.KEYS, F.lit(True).alias("_old"))
        out = out.join(old, columns.KEYS, "left")
        out = out.select(*[F.when(F.col("_old").isNull() & F.col(f.name).isNull(), F.lit(0 if profile.is_numeric(f.dataType) else None).cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name) if f in absent else F.col(f.name) for f in existing.schema.fields])
    result = counts.collect()[0].asDict() | merged.collect()[0].asDict()
    store.write("films", out)
    rows.unpersist()
    raw.unpersist()
    return spark.createDataFrame([result], "processed long, skipped long, merged long")


LEDGER = "path string, length long, modified timestamp, processed long, skipped long, merged long, error string"


def import_files(spark: SparkSession, store: Store, files: list[tuple], settings: Settings | None = None) -> DataFrame:
    """Import (path, length, modified) files one after another, each for itself, and note each in the table ``imports``.

    A file that fails is noted with its error and doesn't stop the others.
    """
    notes = []
    for path, length, modified in files:
        try:
            done = import_csv(spark, store, path, settings).first()
            notes.append((path, length, modified, done.processed, done.skipped, done.merged, None))
        except Exception as error:  # noqa: BLE001
            notes.append((path, length, modified, None, None, None, f"{type(error).__name__}: {error}"[:1000]))
    fresh = spark.createDataFrame(notes, LEDGER)
    known = store.read("imports", fresh.schema)
    if notes:
        store.write("imports", known.join(fresh.select("path"), "path", "left_anti").unionByName(fresh))
    return fresh


def import_folder(spark: SparkSession, store: Store, folder: str, settings: Settings | None = None, again: bool = False) -> list[str]:
    """Every file of a folder, in order of name, but for those imported before and unchanged (or ``again`` all); paths of those that were imported."""
    files = csv_files.listing_with_times(spark, folder)
    if not again and store.exists("imports"):
        known = {(r.path, r.length, r.modified) for r in store.read("imports").where("error is null").select("path", "length", "modified").collect()}
        files = [f for f in files if f not in known]
    return [r.path for r in import_files(spark, store, files, settings).where("error is null").collect()]


def import_cast_csv(spark: SparkSession, store: Store, path: str) -> bool:
    """Merge a cast file into the table ``cast``; False for a file without film, year or actor columns."""
    raw = csv_files.read(spark, path)
    headers = columns.cast_headers([c for c in raw.columns if c not in (csv_files.ORDER, csv_files.FILE)])
    if not headers.usable:
        return False
    rows = cast.cast_rows(raw, headers, csv_files.ORDER)
    out = merge.merge(store.read("cast", CAST), rows, ["actor_name", "movie_name", "release_date"], merge.CAST_FROM_FILES, csv_files.ORDER)
    store.write("cast", cast.fill_language(out, store.read("films", FILMS)))
    return True


def import_cast_folder(spark: SparkSession, store: Store, folder: str) -> list[str]:
    """Every cast file, each for itself: one that fails doesn't stop the others."""
    done = []
    for path in csv_files.listing(spark, folder, "*.{csv,CSV}"):
        try:
            if import_cast_csv(spark, store, path):
                done.append(path)
        except Exception as error:  # noqa: BLE001
            print(f"{path}: {error}")
    return done


def import_cast_pages(store: Store, fetched: DataFrame) -> None:
    """Merge filmography pages (url, actor_name, body) into ``cast``, never over what is known."""
    merge_entries(store, pages.filmography_entries(fetched).where("movie_name is not null and release_date is not null"))


def merge_entries(store: Store, entries: DataFrame) -> None:
    """Merge films of filmography pages into ``cast``, never over what is known."""
    rows = entries.withColumn("page_url", F.col("url")).select("actor_name", "movie_name", "release_date", "language", "genre", "director", "character_name", "page_url", F.struct("url", "ord").alias("_ord"))
    store.write("cast", merge.merge(store.read("cast", CAST), rows, ["actor_name", "movie_name", "release_date"], merge.CAST_FROM_PAGES, "_ord"))


def filmography(store: Store, actor: str, up_to: str | None = None) -> DataFrame:
    return cast.filmography(store.read("cast", CAST), actor, up_to)


def report(rows: list) -> str:
    """A filmography as text, under a heading for each year."""
    lines = []
    for r in rows:
        if r.new_year:
            lines.append(r.release_date[:4])
        lines.append(f"  {r.movie_name}  {r.language or '-'}  {r.director or '-'}  {r.genre or '-'}")
    return "\n".join([*lines, f"{len(rows)} films"])

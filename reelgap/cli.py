"""Command line: import, watch and report. Fetching pages is left to other tools."""

from __future__ import annotations

import argparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgap.plans import cycles, imports
from reelgap.sources.shared import ship_package
from reelgap.sources.store import Store
from reelgap.streaming.folder import watch_folder


def fetched(spark: SparkSession, folder: str, names: tuple[str, ...]) -> dict[str, DataFrame]:
    """Those of the Parquet tables ``names`` that ``folder`` has."""
    found = {}
    for name in names:
        try:
            found[name] = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="reelgap")
    parser.add_argument("--store", required=True, help="folder of the tables")
    parser.add_argument("--settings", help="file of settings as name = value lines")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("import", "batch", "watch", "cast-scan"):
        commands.add_parser(name).add_argument("path")
    gaps = commands.add_parser("fill-gaps", help="folder of fetched tables: slugs, detail_pages, candidates2, pages2, candidates3, pages3, rates")
    gaps.add_argument("path")
    gaps.add_argument("--source1-only", action="store_true")
    actors = commands.add_parser("actor-pages", help="folder of the fetched tables known_pages and pages")
    actors.add_argument("path")
    actors.add_argument("--base", required=True, help="address of the site that has the pages")
    films = commands.add_parser("filmography")
    films.add_argument("name")
    films.add_argument("up_to", nargs="?")
    given = parser.parse_args(args)
    spark = SparkSession.builder.appName("reelgap").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    ship_package(spark)
    store = Store(spark, given.store)
    settings = imports.Settings.load(spark, given.settings) if given.settings else imports.Settings()
    if given.command == "import":
        imports.import_csv(spark, store, given.path, settings).show()
    elif given.command == "batch":
        imports.import_folder(spark, store, given.path, settings)
    elif given.command == "watch":
        watch_folder(spark, store, given.path, f"{given.store}/_stream", settings).awaitTermination()
    elif given.command == "cast-scan":
        imports.import_cast_folder(spark, store, given.path)
    elif given.command == "fill-gaps":
        tables = ("slugs", "detail_pages", "rates") if given.source1_only else ("slugs", "detail_pages", "candidates2", "pages2", "candidates3", "pages3", "rates")
        print(cycles.fill_gaps(store, fetched(spark, given.path, tables), F.current_date(), settings))
    elif given.command == "actor-pages":
        got = fetched(spark, given.path, ("known_pages", "pages"))
        print(cycles.import_actors(store, got["known_pages"], got["pages"], given.base, settings))
    else:
        print(imports.report(imports.filmography(store, given.name, given.up_to).collect()))


if __name__ == "__main__":
    main()

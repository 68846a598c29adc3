"""Import ledger, settings, upkeep of the films' shape, and whole cycles over the store."""

import datetime

import pytest
from pyspark.sql import functions as F

from reelgap import cli
from reelgap.plans import cycles, imports
from reelgap.sources import pages
from reelgap.sources.store import Store
from reelgap.streaming.folder import watch_folder


def test_a_bad_file_does_not_stop_the_others(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("Title,Year\nAlpha,2020\n")
    (tmp_path / "in" / "b.csv").write_text("x\n")
    (tmp_path / "in" / "c.csv").write_text("Title,Year\nGamma,2021\n")
    store = Store(spark, f"file://{tmp_path}/store")
    real = imports.import_csv

    def failing(spark, store, path, settings=None):
        if path.endswith("b.csv"):
            raise ValueError("broken")
        return real(spark, store, path, settings)

    imports.import_csv = failing
    try:
        done = imports.import_folder(spark, store, f"file://{tmp_path}/in")
        assert [p.rpartition("/")[2] for p in done] == ["a.csv", "c.csv"]
        notes = {r.path.rpartition("/")[2]: r for r in store.read("imports").collect()}
        assert notes["b.csv"].error == "ValueError: broken" and notes["a.csv"].processed == 1
        assert imports.import_folder(spark, store, f"file://{tmp_path}/in") == []  # only the failed one is tried again
        watch_folder(spark, Store(spark, f"file://{tmp_path}/store2"), f"file://{tmp_path}/in", f"file://{tmp_path}/ledger", once=True).awaitTermination()
        assert {r.movie_name for r in Store(spark, f"file://{tmp_path}/store2").read("films").collect()} == {"Alpha", "Gamma"}
    finally:
        imports.import_csv = real


def test_settings(spark, tmp_path):
    (tmp_path / "s.properties").write_text("# limits\nfuzzy_auto = 0.9\nfuzzy_max_pairs=none  # no limit\nenrichment = TRUE\nother=1\n\n")
    s = imports.Settings.load(spark, f"file://{tmp_path}/s.properties")
    assert s == imports.Settings(fuzzy_auto=0.9, fuzzy_max_pairs=None, enrichment=True)


def test_upkeep(spark):
    rows = [("A", "2020", None, 1.0, 0.0, 7.0), ("A", "2020", "Unknown", 0.0, 5.0, 0.0), ("B", "2021", "Hindi", 2.0, None, None)]
    films = spark.createDataFrame(rows, "movie_name string, release_date string, language string, votes double, gross double, worldwide double")
    out = {r.movie_name: r for r in cycles.upkeep(films, {"gross": "revenue"}, {"worldwide": "revenue"}).collect()}
    assert set(out) == {"A", "B"} and (out["A"].votes, out["A"].revenue, out["A"].language) == (1.0, 5.0, "Unknown")
    assert out["B"].budget == 0 and out["B"].genre is None and "worldwide" not in out["B"].asDict()
    assert cycles.upkeep(cycles.upkeep(films)).count() == 2


DETAIL = "<html>" + " " * 200 + ">Worldwide</div> <div class='x'>₹ 1,000 Cr </div>>Budget:</span> <span>₹ 200 Cr</span>"


def test_a_gap_filling_cycle(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    rows = [("Alpha Star", "2022-04-14", "Hindi", 0.0, 0.0), ("Beta River", "2021", "English", None, 3.0), ("Gamma Hill", "2020-02-02", "Tamil", 9.0, 0.0)]
    store.write("films", spark.createDataFrame(rows, "movie_name string, release_date string, language string, revenue decimal(38,6), budget decimal(38,6)".replace("decimal(38,6)", "double")))
    day, now = datetime.date(2022, 4, 14), datetime.datetime(2024, 1, 5)
    fetched = {
        "slugs": spark.createDataFrame([(0, "Alpha_Starr_2022", "Alpha Starr", "2022"), (1, "None_2022", "None", "2022")], "ord int, slug string, name string, year string"),
        "detail_pages": spark.createDataFrame([("Alpha_Starr_2022", DETAIL), ("None_2022", DETAIL)], "slug string, body string"),
        "candidates2": spark.createDataFrame([("Beta River", "2021", 0, "/title/tt1", "Beta River", "2021"), ("Beta River", "2021", 1, "/title/tt2", "Beta", "1990")], "movie_name string, release_date string, ord int, href string, name string, year string"),
        "pages2": spark.createDataFrame([("/title/tt1", " " * 200 + "Worldwide</b> $12,345 ")], "href string, body string"),
        "candidates3": spark.createDataFrame([("Gamma Hill", "2020-02-02", 0, "https://x/box-office/gamma", "Gamma Hill", "2020")], "movie_name string, release_date string, ord int, href string, name string, year string"),
        "pages3": spark.createDataFrame([("https://x/box-office/gamma", " " * 200 + "Film Budget: Rs. 10 Crore")], "href string, body string"),
        "rates": spark.createDataFrame([(day, "INR", "USD", 0.013, now), (datetime.date(2020, 2, 2), "INR", "USD", 0.014, now)], "rate_date date, from_currency string, to_currency string, rate double, fetched_at timestamp"),
    }
    done = cycles.fill_gaps(store, fetched, F.lit("2024-01-05").cast("date"))
    films = {r.movie_name: r for r in store.read("films").collect()}
    assert (films["Alpha Star"].revenue, films["Alpha Star"].budget) == (130_000_000, 26_000_000)
    assert films["Beta River"].revenue == 12_345 and films["Beta River"].budget == 3
    assert films["Gamma Hill"].revenue == 9 and films["Gamma Hill"].budget == 1_400_000
    assert store.read("rates").count() == 2
    assert done["source1"] == {"offered": 1, "no_data": 0, "matched_rows": 1, "changed_rows": 1} and done["source3"]["changed_rows"] == 1
    again = cycles.fill_gaps(store, fetched, F.lit("2024-01-05").cast("date"))
    assert {k: v["changed_rows"] for k, v in again.items()} == {"source1": 0, "source2": 0, "source3": 0} and store.read("rates").count() == 2


PAGE = '<meta property="og:url" content="https://x/news/List_Of_All_{0}_Movies">{1}' + " " * 500 + "<table><tr><th scope='col'>Sr.</th><th scope='col'>Movie</th><th scope='col'>Year</th></tr><tr><td>1</td><td>{2}</td><td>2001</td></tr></table>"


def test_actors_by_known_direct_and_misspelt_pages(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    store.write("cast", spark.createDataFrame([(a, "Old", "2000") for a in ("Ann Lee", "Bob Ray", "Raj Kumar", "No Body")], "actor_name string, movie_name string, release_date string").select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in imports.CAST.fields[3:]]))
    known = spark.createDataFrame([("Ann_Leee", "https://x/news/List_Of_All_Ann_Leee_Movies_2")], "slug string, url string")
    base = "https://x"
    work = {r.actor_name: (r.url, r.typo_url) for r in cycles.actor_work(store.read("cast").select("actor_name").distinct(), known, base).collect()}
    assert work["Ann Lee"][0].endswith("Ann_Leee_Movies_2") and work["Bob Ray"] == (f"{base}/news/List_Of_All_Bob_Ray_Movies", f"{base}/news/List_Of_All_Bob_Rya_Movies")
    fetched = [("https://x/news/List_Of_All_Ann_Leee_Movies_2", PAGE.format("Ann_Leee", '<meta property="og:title" content="Films of Ann"/>', "One")), (f"{base}/news/List_Of_All_Bob_Ray_Movies", PAGE.format("Bob_Ray", "", "Two")), (f"{base}/news/List_Of_All_Raj_Kumra_Movies", PAGE.format("Raj_Kumra", "", "Three"))]
    done = cycles.import_actors(store, known, spark.createDataFrame(fetched, "url string, body string"), base)
    assert done == {"actors": 4, "found": 3, "not_found": 1, "entries": 3, "rows_before": 4, "rows_after": 7}
    assert {(r.actor_name, r.movie_name) for r in store.read("cast").where("page_url is not null").collect()} == {("Ann Lee", "One"), ("Bob Ray", "Two"), ("Raj Kumar", "Three")}


def test_sub_sitemaps_only_as_a_fallback(spark):
    maps = spark.createDataFrame([(0, "<loc>https://x/news/List_Of_All_A_B_Movies</loc>"), (1, "<loc>https://y/news/List_Of_All_A_B_Movies_2</loc>")], "ord int, body string")
    assert [tuple(r) for r in pages.actor_pages(maps).collect()] == [("A_B", "https://y/news/List_Of_All_A_B_Movies_2")]
    assert [tuple(r) for r in pages.actor_pages(maps, host="x").collect()] == [("A_B", "https://x/news/List_Of_All_A_B_Movies")]
    assert [tuple(r) for r in pages.actor_pages(maps.limit(0), fallback=maps, host="x").collect()] == [("A_B", "https://x/news/List_Of_All_A_B_Movies")]
    main = spark.createDataFrame([("<loc>https://x/sitemap-1.xml</loc><loc>https://x/page</loc><loc>https://x/a/sitemap2.xml</loc>",)], "body string")
    assert [r.url for r in pages.sub_sitemaps(main).orderBy("ord").collect()] == ["https://x/sitemap-1.xml", "https://x/a/sitemap2.xml"]


def test_command_line_reads_what_there_is(spark, tmp_path):
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{tmp_path}/slugs.parquet")
    assert set(cli.fetched(spark, str(tmp_path), ("slugs", "rates"))) == {"slugs"}
    with pytest.raises(SystemExit):
        cli.main(["--store", "x", "unknown"])

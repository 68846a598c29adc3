"""Imports, merges, gap-filling, pages and the stream, end to end on small inputs."""

import datetime

from pyspark.sql import functions as F

from reelgap.operators import enrich, match, merge, profile
from reelgap.plans import gapfill, imports
from reelgap.sources import csv_files, pages
from reelgap.sources.store import RATES, Store
from reelgap.streaming.folder import watch_folder

FILE_A = """,title,release_date,original_language,vote_average,vote_count,Gross Worldwide,Timing(min),overview
0,Alpha Star,2022-04-14,hi,8.1,"1,204","12,500,000",168 min,x
1,alpha star,2022-04-14,hi,8.2,1300,-,,y
2,Beta River,2021,ta,-,10,,142,"z ""q"",
second line"
3,,2020-01-01,te,5,1,1,1,skipped: no name
"""
FILE_B = """Film,Release_Date,original_language,worldwide,Critics
Alpha Starr,2022-04-14,hi,,7
Gamma Hill,2020,en,5,
"""
CAST = """Name,Year,Genre,Director,Rating,Votes,Duration,Actor 1,Actor 2,Actor 3
Alpha Star,-2019,Drama,D One,7.1,"2,000",120 min,Ann Lee,,Raj Rao
Beta River,2019.0,,D Two,-,10,95 min,Raj Rao,Ann Lee,-
,2019,,,,,,Nobody,,
"""


def films(store):
    return {(r.movie_name, r.release_date, r.language): r for r in store.read("films").collect()}


def test_three_imports(spark, tmp_path):
    for name, text in (("a.csv", FILE_A), ("b.csv", FILE_B)):
        (tmp_path / name).write_text(text)
    store = Store(spark, f"file://{tmp_path}/store")
    counters = imports.import_csv(spark, store, f"file://{tmp_path}/a.csv").first()
    assert (counters.processed, counters.skipped, counters.merged) == (3, 1, 0)
    first = films(store)
    assert set(first) == {("Alpha Star", "2022-04-14", "Hindi"), ("alpha star", "2022-04-14", "Hindi"), ("Beta River", "2021", "Tamil")}
    alpha = first["Alpha Star", "2022-04-14", "Hindi"]
    assert (alpha.revenue, alpha.votes, alpha.runtime, alpha.release_day) == (12_500_000, 1204, 168, "Thursday")
    assert first["Beta River", "2021", "Tamil"].revenue is None and "overview" not in store.columns("films")
    imports.import_csv(spark, store, f"file://{tmp_path}/a.csv")  # both spellings now meet in the smallest
    assert set(films(store)) == set(first)
    imports.import_csv(spark, store, f"file://{tmp_path}/b.csv", imports.Settings(fuzzy_auto=0.7, fuzzy_warn=0.6))
    third = films(store)
    assert third["Alpha Star", "2022-04-14", "Hindi"].revenue is None  # a later file's blank erases
    assert third["Alpha Star", "2022-04-14", "Hindi"].critics == 7 and third["Beta River", "2021", "Tamil"].critics == 0
    gamma = third["Gamma Hill", "2020", "English"]
    assert (gamma.revenue, gamma.critics, gamma.votes, gamma.runtime) == (5, None, 0, 0)


def test_short_rows(spark, tmp_path):
    (tmp_path / "s.csv").write_text("Title,Year,Title,X\nA,2000\nB,2001,b,1,extra\n\n")
    rows = csv_files.read(spark, f"file://{tmp_path}/s.csv").collect()
    assert [(r.Title, r.Year, r.X) for r in rows] == [("A", "2000", None), ("B", "2001", "1")]


def test_cast_import_and_filmography(spark, tmp_path):
    (tmp_path / "c.csv").write_text(CAST)
    (tmp_path / "no.csv").write_text("x,y\n1,2\n")
    store = Store(spark, f"file://{tmp_path}/store")
    known = spark.createDataFrame([("alpha star", "2019-05-01", "Hindi"), ("Beta River", "2019", "Unknown")], "movie_name string, release_date string, language string")
    store.write("films", known)
    assert len(imports.import_cast_folder(spark, store, f"file://{tmp_path}")) == 1
    rows = {(r.actor_name, r.movie_name): r for r in store.read("cast").collect()}
    assert {k: r.role_position for k, r in rows.items()} == {("Ann Lee", "Alpha Star"): 1, ("Raj Rao", "Alpha Star"): 3, ("Raj Rao", "Beta River"): 1, ("Ann Lee", "Beta River"): 2}
    assert rows["Ann Lee", "Alpha Star"].language == "Hindi" and rows["Ann Lee", "Beta River"].language is None
    assert rows["Ann Lee", "Alpha Star"].runtime == "120" and rows["Ann Lee", "Alpha Star"].votes == 2000
    shown = imports.filmography(store, " ANN lee", "2019").collect()
    assert [r.movie_name for r in shown] == ["Alpha Star", "Beta River"] and [r.new_year for r in shown] == [True, False]
    assert imports.report(shown).splitlines()[0] == "2019" and imports.report(shown).endswith("2 films")


PAGE = (
    '<meta property="og:url" content="https://x/news/List_Of_All_Ann_Lee_Movies"><meta property="og:title" content="List Of All Ann Lee Movies 2020">' + " " * 500
    + "<table><tr><th scope='col'>Sr.</th><th scope='col'>Movie</th><th scope='col'>Year</th><th scope='col'>Role</th>"
    + "<tr><th scope='row'>1</th><td><a href='/movie/Alpha_Star_2019'>Alpha Star2019</a></td><td></td><td>Lead</td></tr>"
    + "<tr><th scope='row'>2</th><td>Old One</td><td>1975</td><td>n/a</td></tr><tr><th scope='row'>3</th><td>77</td><td>1999</td><td></td></tr></table>"
)


def test_filmography_pages(spark, tmp_path):
    fetched = [("u1", "Ann Lee", PAGE), ("u2", "Bob Ray", PAGE), ("u3", "Ann Lee", PAGE.replace("List_Of_All", "Other")), ("u4", "Ann Lee", PAGE.split("<table>")[0] + '<ul><li><a href="/movie/Beta_2001">Beta</a></li><li>none</li></ul>')]
    out = pages.filmography_entries(spark.createDataFrame(fetched, "url string, actor_name string, body string")).collect()
    assert sorted((r.url, r.movie_name, r.release_date, r.character_name) for r in out) == [("u1", "Alpha Star", "2019", "Lead"), ("u4", "Beta", "2001", None)]
    store = Store(spark, f"file://{tmp_path}/store")
    imports.import_cast_pages(store, spark.createDataFrame(fetched, "url string, actor_name string, body string"))
    assert {r.page_url for r in store.read("cast").collect()} == {"u1", "u4"}


def test_merge_rules(spark):
    old = spark.createDataFrame([(1, -1.0, 0.0, "", 5.0), (2, None, 5.0, "a", None), (3, 4.0, None, None, 1.0)], "k int, np double, z double, b string, o double")
    new = spark.createDataFrame([(1, 9.0, 9.0, "n", None, 1), (2, 9.0, 9.0, "n", 7.0, 1), (3, 9.0, None, None, 2.0, 1), (3, 8.0, 8.0, "m", None, 2), (4, 1.0, 1.0, "q", 1.0, 3)], "k int, np double, z double, b string, o double, i int")
    rules = {"np": "if_nonpositive", "z": "if_zero", "b": "if_blank", "o": "overwrite"}
    assert sorted(map(tuple, merge.merge(old, new, ["k"], rules, "i").collect())) == [(1, 9.0, 9.0, "n", None), (2, 9.0, 5.0, "a", 7.0), (3, 4.0, 8.0, "m", None), (4, 1.0, 1.0, "q", 1.0)]
    once = merge.merge(old, new, ["k"], rules, "i")
    assert sorted(map(tuple, merge.merge(once, new, ["k"], rules, "i").collect())) == sorted(map(tuple, once.collect()))
    assert merge.merge(old, new, ["k"], rules, "i", insert=False).count() == 3


def test_profile_and_evolution(spark):
    df = spark.createDataFrame([("1,234", "abc", "", "min"), ("12 min", "1", "-", "min"), ("-", "2", "", "")], "a string, b string, c string, d string")
    assert profile.infer(df, df.columns) == {"a": "NUMERIC", "b": "TEXT", "c": "TEXT", "d": "TEXT"}
    grown = profile.evolve(spark.createDataFrame([("x",)], "k string"), {"n": "NUMERIC", "t": "TEXT"})
    assert tuple(grown.first()) == ("x", 0, None) and dict(grown.dtypes)["n"] == "decimal(38,6)"


def test_canonical_names(spark):
    stored = spark.createDataFrame([("Alpha Star", "2022"), ("Alpha Start", "2022"), ("Beta", "2021")], "movie_name string, release_date string")
    coming = spark.createDataFrame([("alpha star", "2022", 1), ("Beta", "2021", 2), ("Beta", "2020", 3)], "movie_name string, release_date string, i int")
    assert [tuple(r) for r in match.canonical_names(coming, stored, "i").collect()] == [("alpha star", "2022", "Alpha Star")]
    assert match.canonical_names(coming, stored, "i", warn=0.6, auto=0.6).first().canonical == "Alpha Start"  # the close match goes first
    assert match.canonical_names(coming, stored, "i", max_pairs=2).count() == 0


def test_gap_filling_by_source(spark):
    table = spark.createDataFrame([("Alpha Star", "2022-04-14", "Hindi", -1.0, 0.0, 0.0, 0.0, None, ""), ("Beta River", "2021", "Tamil", None, 7.0, 0.0, 0.0, "Drama", None), ("Gamma", "2020", "English", 0.0, 0.0, 0.0, 0.0, None, None)], "movie_name string, release_date string, language string, revenue double, budget double, runtime double, rating_10 double, genre string, status string")
    as_of = F.lit("2024-01-01").cast("date")
    day = datetime.date
    rates = spark.createDataFrame([(day(2022, 4, 14), "INR", "USD", 0.01, None), (day(2024, 1, 1), "INR", "USD", 0.02, None)], RATES)
    slugs = pages.film_slugs(spark.createDataFrame([("<loc>https://h/movie/Alpha_Star_2022</loc><loc>https://h/movie/Other_2022</loc>",)], "body string"))
    body = " " * 200 + ">Worldwide</div> <div>₹120.5 Cr</div>>Budget:</span> <span>₹50 Cr</span>>Runtime:</span> <span>2h 30m</span>>Genre:</span> <span>Action</span>"
    one = gapfill.source1(table, slugs, spark.createDataFrame([("Alpha_Star_2022", body)], "slug string, body string"), rates, as_of)
    a = one.where("movie_name = 'Alpha Star'").first()
    assert (a.revenue, a.budget, a.runtime, a.genre) == (12_050_000.0, 5_000_000.0, 150.0, "Action")
    search = spark.createDataFrame([("Gamma", "2020", '<a href="/title/tt1/">Gamma (2020)</a><a href="/title/tt2/">Gamma (1999)</a>'), ("Beta River", "2021", "")], "movie_name string, release_date string, body string")
    two = gapfill.source2(one, pages.source2_candidates(search, ["movie_name", "release_date"]), spark.createDataFrame([("/title/tt1/", " " * 200 + "Worldwide $1,234 Production Budget $5,000")], "href string, body string"))
    g = two.where("movie_name = 'Gamma'").first()
    assert (g.revenue, g.budget) == (1234.0, 5000.0)
    search = spark.createDataFrame([("Beta River", "2021", '<a href="https://k/box-office/beta-river-2021/">Beta River Box Office Collection Day 9</a>')], "movie_name string, release_date string, body string")
    three = gapfill.source3(two, pages.source3_candidates(search, ["movie_name", "release_date"]), spark.createDataFrame([("https://k/box-office/beta-river-2021/", " " * 200 + "Worldwide Total Collection: Rs. 250 Crore")], "href string, body string"), rates, as_of)
    b = three.where("movie_name = 'Beta River'").first()
    assert (b.revenue, b.budget) == (50_000_000.0, 7.0)


def test_enrichment(spark):
    rows = spark.createDataFrame([("2020-01-05", "hi", None), ("2020", "fr", "Republic of Korea, South Korea"), ("x", None, "nowhere")], "d string, l string, c string")
    found = spark.createDataFrame([("IN", 2020, "gdp", '[{},[{"value":2660000000000}]]'), ("IN", 2020, "inflation", '[{},[{"value":6.62}]]'), ("KR", 2020, "gdp", "[{}]")], "iso string, year int, indicator string, body string")
    events = spark.createDataFrame([("2020-01-05", "India", '{"event_type":"Holiday","event_name":"X"}')], "date string, country string, body string")
    got = {r.d: r for r in enrich.enrich(rows, "d", "l", "c", found, events).collect()}
    assert (got["2020-01-05"].gdp_usd_billions, got["2020-01-05"].inflation_rate_pct, got["2020-01-05"].release_event_name) == (2660.0, 6.62, "X")
    assert got["2020"].gdp_usd_billions is None and got["2020"].release_event_type is None and got["x"].inflation_rate_pct is None


def test_stream_reads_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.CSV").write_text("Title,Year,votes\nA,2000,1\n")
    store = Store(spark, f"file://{tmp_path}/store")
    run = lambda: watch_folder(spark, store, f"file://{tmp_path}/in", f"file://{tmp_path}/ledger", once=True).awaitTermination()
    run()
    snapshot = store.current("films")
    run()
    assert store.current("films") == snapshot
    (tmp_path / "in" / "b.csv").write_text("Title,Year,votes\nB,2001,2\n")
    run()
    assert sorted(r.movie_name for r in store.read("films").collect()) == ["A", "B"]


def test_stream_query_matches_spellings(spark, monkeypatch):
    from reelgap.plans import catalogue
    from reelgap.streaming import folder

    class Seen(Exception):
        pass

    def seen(spark, store, source, ledger, settings, **_):
        raise Seen(settings.fuzzy_max_pairs)

    monkeypatch.setattr(folder, "watch_folder", seen)
    try:
        catalogue.q_stream_folder(spark, "/root/testdata/sf0.001")
    except Seen as e:
        assert e.args == (None,)
    else:
        raise AssertionError("no stream was started")

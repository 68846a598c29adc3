"""Truth tables of the scalar functions."""

import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelgap.functions import clean, extract, similarity
from reelgap.operators import columns


def run(spark, f, *inputs):
    rows = spark.createDataFrame([tuple(i) if isinstance(i, tuple) else (i,) for i in inputs], ", ".join(f"c{k} string" for k in range(len(inputs[0]) if isinstance(inputs[0], tuple) else 1)))
    return [r[0] for r in rows.select(f(*[F.col(c) for c in rows.columns]).alias("x")).collect()]


@pytest.mark.parametrize("function,pairs", [
    (clean.normalize_year, {"-2019": "2019", "2019.0": "2019", "2019-05-03": "2019-05-03", "2019 (India)": "2019", "20191231": "2019", "19": None, "-": None}),
    (clean.normalize_name, {"K.G.F: Chapter 2": "k g f chapter 2", "日本": "", " A  b!": "a b"}),
    (clean.runtime_minutes, {"2h 30m": 150, "150 mins": 150, "142": 142, "0m": None, "N/A": None}),
    (clean.filmography_slug, {"A.R. Rahman": "A_R_Rahman"}),
    (clean.typo_slug, {"Akshay_Kumar": "Akshay_Kumra", "Ann": None, "A_B": None, "x": None}),
    (clean.slug_name, {"KGF_Chapter_2_2022": "KGF Chapter 2"}),
    (clean.slug_year, {"KGF_Chapter_2_2022": "2022", "KGF": None}),
    (clean.iso_date, {"2023-02-30": None, "2023-2-3": None, " 2023-02-03": datetime.date(2023, 2, 3), "2023": None}),
    (clean.weekday, {"2024-02-29": "Thursday", "x": None}),
    (clean.film_year, {"in 1979 and 2039": "2039", "12001": None}),
    (clean.expand_language, {"HI": "Hindi", " xx ": "xx"}),
    (clean.strip_tags, {"<b>a&amp;lt;</b>&nbsp;": "a<", "\t x\x0b": "x"}),
    (clean.strip_year_suffix, {"Mr.Bond1992": "Mr.Bond", "1992": "1992"}),
    (clean.strip_label_noise, {"Alpha Total Box Office Collection Day 3 more": "Alpha"}),
    (clean.blank_to_null, {" - ": None, "\t": None, " a": "a"}),
    (extract.usd_rate, {'{"currency":"USD","rate":0.0131}': 0.0131, "x": None}),
    (extract.indicator_value, {'[{},[{"value":123}]]': 123.0, "[{}]": None, "x": None}),
    (extract.crawl_delay_ms, {"Crawl-Delay: 3": 3000, "": 1000}),
])
def test_truth_tables(spark, function, pairs):
    assert run(spark, function, *pairs) == list(pairs.values())


def test_numbers(spark):
    values = {"1,204": 1204, "168 min": 168, "-": None, "": None, "1e5": 100000, "1d": None, "NaN": None, ".5": 0.5, "abc": None}
    assert [None if x is None else float(x) for x in run(spark, clean.number, *values)] == list(values.values())


def test_money_and_scaling(spark):
    row = spark.range(1).select(clean.crore_to_usd(F.lit(250.0), F.lit(0.01112)).alias("a"), clean.scaled_indicator(F.lit(-0.125), 1).alias("b"), clean.rate_date(F.lit("2022"), F.lit("2024-01-01").cast("date")).alias("c"), clean.rate_date(F.lit("2030-01-01"), F.lit("2024-01-01").cast("date")).alias("d")).first()
    assert row.a == 27_800_000 and row.b == -0.12 and row.c == row.d == datetime.date(2024, 1, 1)


def test_similarity(spark):
    edit = lambda g: lambda a, b: F.round(similarity.edit_similarity(a, b, g), 4)
    assert run(spark, edit(0.5), ("akshay kumar", "akshay kumra"), ("ram", "ram ram"), ("", "")) == [0.8333, 0.0, 1.0]
    assert run(spark, edit(0.4), ("ram", "ram ram")) == [0.4286]
    assert run(spark, lambda a, b: F.round(similarity.trigram_similarity(a, b), 6), ("word", "two words"), ("", ""), ("ab", "AB")) == [0.363636, 0.0, 1.0]


def test_robots(spark):
    rules = "User-agent: a\nDisallow: /\nUser-agent: *\nDisallow: /private\nDisallow:"
    assert run(spark, extract.path_allowed, (rules, "/x"), (rules, "/private/1"), ("", "/")) == [True, False, True]


def test_events(spark):
    bodies = ['```json\n{"event_type":"Holiday","event_name":"Diwali","event_detail":"null"}\n```', '{"event_name":"x"}', "nothing"]
    assert [tuple(r) for r in run(spark, extract.event, *bodies)] == [("Holiday", "Diwali", None), ("None", "x", None), ("None", None, None)]


def test_headers():
    assert {h: columns.column_name(h) for h in (" Film ", "Year", "Release Date", "Gross Worldwide", "Timing(min)", "__A  b__")} == {" Film ": "movie_name", "Year": "release_date", "Release Date": "release_date", "Gross Worldwide": "revenue", "Timing(min)": "runtime", "__A  b__": "a_b"}
    assert columns.mapping(["", "title", "name", "overview", "X"]) == {"movie_name": "title", "x": "X"}
    found = columns.cast_headers(["Name", "Film", "Year", "Actor 2", "Star", "cast 1", "Lead", "Actor 2 "])
    assert found.fields == {"movie": "Name", "year": "Year"} and found.actors == ["cast 1", "Actor 2 ", "Star"]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.text("abc d", max_size=8), st.text("abc d", max_size=8)), min_size=1, max_size=20))
def test_similarities_are_symmetric(spark, pairs):
    for f in (lambda a, b: similarity.edit_similarity(a, b, 0.4), similarity.trigram_similarity):
        there, back = run(spark, f, *pairs), run(spark, f, *[(b, a) for a, b in pairs])
        assert there == back and all(0 <= x <= 1 for x in there)

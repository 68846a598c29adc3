"""Every registered query of the engine, with the SQL that states the same result.

The source system's tables aren't among the test tables, so each query applies an operator to stand-ins: films are
derived from ``part``, casts from orders and their lines, pages from ``pages``. All queries read whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgap.functions import clean, extract, similarity, values
from reelgap.operators import cast, columns, enrich, match, merge, profile
from reelgap.plans import gapfill
from reelgap.sources import pages as page_ops
from reelgap.sources.shared import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

TITLES = """titles AS (
  SELECT p_partkey AS ord, p_name AS movie_name, CAST(1980 + p_partkey % 45 AS VARCHAR) AS year, p_type AS language, p_size AS budget,
    CASE WHEN p_partkey % 3 <> 0 THEN CAST(1980 + p_partkey % 45 AS VARCHAR) || '-01-01' ELSE CAST(1980 + p_partkey % 45 AS VARCHAR) END AS release_date,
    CASE p_partkey % 4 WHEN 0 THEN 0.0 WHEN 1 THEN NULL ELSE p_retailprice END AS revenue
  FROM part)"""
NORM = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'))"
EDIT = "CASE WHEN {a} = {b} THEN 1.0 WHEN least(length({a}), length({b})) / greatest(length({a}), length({b}), 1)::DOUBLE < {g} THEN 0.0 ELSE 1.0 - levenshtein({a}, {b}) / greatest(length({a}), length({b}))::DOUBLE END"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    year = (1980 + k % 45).cast("string")
    revenue = F.when(k % 4 == 0, 0.0).when(k % 4 == 1, None).otherwise(F.col("p_retailprice"))
    return table(spark, sf_dir, "part").select(k.alias("ord"), F.col("p_name").alias("movie_name"), year.alias("year"), F.col("p_type").alias("language"), F.col("p_size").alias("budget"), F.when(k % 3 != 0, F.concat(year, F.lit("-01-01"))).otherwise(year).alias("release_date"), revenue.alias("revenue"))


# Distinct titles, missing figures, first spellings


@query(f"WITH {TITLES} SELECT movie_name, left(release_date, 4) AS year, min(release_date) AS release_date FROM titles WHERE length(release_date) >= 4 GROUP BY 1, 2")
def q_distinct_movie_year(spark, sf_dir):
    return gapfill.movie_years(titles(spark, sf_dir).drop("year"))


@query(f"WITH {TITLES} SELECT movie_name, left(release_date, 4) AS year, min(release_date) AS release_date FROM titles WHERE left(release_date, 4) >= '1980' AND (coalesce(revenue, 0) = 0 OR coalesce(budget, 0) = 0) GROUP BY 1, 2")
def q_missing_revenue(spark, sf_dir):
    return gapfill.missing(titles(spark, sf_dir).drop("year"))


@query(f"WITH {TITLES} SELECT movie_name, left(release_date, 4) AS year, min(release_date) AS release_date FROM titles WHERE (coalesce(revenue, 0) = 0 OR coalesce(budget, 0) = 0) AND ord % 3 < 2 GROUP BY 1, 2")
def q_missing_revenue_lang(spark, sf_dir):
    language = F.when(F.col("ord") % 3 == 0, "Hindi").when(F.col("ord") % 3 == 1, "TAMIL").otherwise("English")
    return gapfill.missing(titles(spark, sf_dir).withColumn("language", language).drop("year"), indian_only=True)


@query("SELECT DISTINCT c_name AS actor_name FROM customer JOIN orders ON o_custkey = c_custkey ORDER BY 1")
def q_distinct_actors(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    return rows.select(F.col("c_name").alias("actor_name")).where("actor_name is not null").distinct().orderBy("actor_name")


@query(f"WITH {TITLES}, v AS (SELECT CASE WHEN ord % 2 = 1 THEN upper(movie_name) ELSE movie_name END AS movie_name, release_date, ord FROM titles) SELECT lower(movie_name) AS name_key, release_date, arg_min(movie_name, ord) AS movie_name FROM v GROUP BY 1, 2")
def q_first_spelling_pairs(spark, sf_dir):
    rows = titles(spark, sf_dir).withColumn("movie_name", F.when(F.col("ord") % 2 == 1, F.upper("movie_name")).otherwise(F.col("movie_name")))
    return match.first_spellings(rows, "movie_name", "release_date", "ord")


# Matching


@query(f"WITH {TITLES} SELECT DISTINCT upper(i.movie_name) AS movie_name, i.release_date, min(s.movie_name) OVER (PARTITION BY i.movie_name, i.release_date) AS canonical FROM titles i JOIN titles s ON s.release_date = i.release_date AND s.movie_name = i.movie_name AND s.ord % 2 = 0 WHERE i.ord % 2 = 1")
def q_exact_ci_match(spark, sf_dir):
    t = titles(spark, sf_dir)
    return match.exact_matches(t.where("ord % 2 = 1").select(F.upper("movie_name").alias("movie_name"), "release_date").distinct(), t.where("ord % 2 = 0"))


GRAMS = "list_distinct(flatten(list_transform(list_filter(string_split_regex(lower({0}), '[^a-z0-9]+'), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"


@query(f"""WITH {TITLES},
i AS (SELECT DISTINCT substr(movie_name, 1, 2) || substr(movie_name, 4) AS movie_name, year AS release_date FROM titles WHERE ord % 2 = 1),
s AS (SELECT DISTINCT movie_name AS canonical, year AS release_date FROM titles WHERE ord % 2 = 0),
g AS (SELECT i.*, s.canonical, {GRAMS.format("movie_name")} AS a, {GRAMS.format("canonical")} AS b FROM i JOIN s USING (release_date)
  WHERE least(length(movie_name), length(canonical)) / greatest(length(movie_name), length(canonical), 1)::DOUBLE >= 0.7 AND lower(movie_name) <> lower(canonical)),
m AS (SELECT movie_name, release_date, canonical, len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b)))::DOUBLE AS s FROM g)
SELECT movie_name, release_date, canonical, round(s, 6) AS similarity, CASE WHEN round(s, 3) >= 0.8 THEN 'merge' ELSE 'warn' END AS tier
FROM m WHERE s >= 0.5 QUALIFY row_number() OVER (PARTITION BY movie_name, release_date ORDER BY s DESC, canonical) = 1""")
def q_trigram_match_top1(spark, sf_dir):
    t = titles(spark, sf_dir).select("ord", "movie_name", F.col("year").alias("release_date"))
    typed = F.concat(F.substring("movie_name", 1, 2), F.expr("substr(movie_name, 4)"))
    rows = match.trigram_matches(t.where("ord % 2 = 1").withColumn("movie_name", typed), t.where("ord % 2 = 0"), warn=0.5, auto=0.8)
    return rows.withColumn("similarity", F.round("similarity", 6))


@query(f"""WITH {TITLES},
a AS (SELECT DISTINCT movie_name, year, {NORM.format("movie_name")} AS x FROM titles WHERE ord % 2 = 1),
b AS (SELECT DISTINCT movie_name AS candidate, year, {NORM.format("movie_name")} AS y FROM titles WHERE ord % 2 = 0),
m AS (SELECT movie_name, year, candidate, {EDIT.format(a="x", b="y", g=0.5)} AS score FROM a JOIN b USING (year))
SELECT movie_name, year, candidate, round(score, 6) AS score FROM m WHERE score >= 0.7 QUALIFY row_number() OVER (PARTITION BY movie_name, year ORDER BY score DESC, candidate) = 1""")
def q_levenshtein_best_match(spark, sf_dir):
    t = titles(spark, sf_dir)
    left = t.where("ord % 2 = 1").select("movie_name", "year").distinct()
    right = t.where("ord % 2 = 0").select(F.col("movie_name").alias("candidate"), "year").distinct()
    return match.best_by_name(left, right, "movie_name", "candidate", ["year"], 0.5, 0.70, ["movie_name", "year"]).withColumn("score", F.round("score", 6))


@query(f"""WITH a AS (SELECT c_name AS actor_name, {NORM.format("c_name")} AS x FROM customer), b AS (SELECT s_name AS slug, {NORM.format("s_name")} AS y FROM supplier),
m AS (SELECT actor_name, slug, {EDIT.format(a="x", b="y", g=0.4)} AS score FROM a, b)
SELECT actor_name, slug, round(score, 6) AS score FROM m WHERE score >= 0.6 QUALIFY row_number() OVER (PARTITION BY actor_name ORDER BY score DESC, slug) = 1""")
def q_actor_slug_match_guard04(spark, sf_dir):
    actors, slugs = table(spark, sf_dir, "customer").select(F.col("c_name").alias("actor_name")).distinct(), table(spark, sf_dir, "supplier").select(F.col("s_name").alias("slug"))
    return match.best_by_name(actors, slugs, "actor_name", "slug", [], 0.4, 0.6, ["actor_name"]).withColumn("score", F.round("score", 6))


@query(f"""WITH p AS (SELECT page_id, {NORM.format("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS x, {NORM.format("regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1)")} AS y FROM pages)
SELECT page_id, round({EDIT.format(a="x", b="y", g=0.3)}, 6) AS score, {EDIT.format(a="x", b="y", g=0.3)} >= 0.6 AS same FROM p""")
def q_title_check_guard03(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("a"), F.regexp_extract("html", "<h1[^>]*>([^<]*)</h1>", 1).alias("b"))
    rows = rows.withColumn("score", similarity.title_similarity(F.col("a"), F.col("b"), 0.3))
    return rows.select("page_id", F.round("score", 6).alias("score"), (F.col("score") >= 0.6).alias("same"))


# Cleaning


@query(f"SELECT doc_id, md5({NORM.format('text')}) AS normalized FROM documents")
def q_name_normalize(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(clean.normalize_name(F.col("text"))).alias("normalized"))


RAW = "CASE l_linenumber % 7 WHEN 0 THEN '-' WHEN 1 THEN '1,' || CAST(CAST(l_quantity AS INTEGER) + 100 AS VARCHAR) || '.5 min' WHEN 2 THEN ' ' || CAST(l_partkey AS VARCHAR) || ' ' WHEN 3 THEN '' WHEN 4 THEN CAST(l_suppkey AS VARCHAR) || 'd' WHEN 5 THEN 'NaN' ELSE CAST(l_orderkey AS VARCHAR) || 'MIN' END"


@query(f"WITH r AS (SELECT l_orderkey, l_linenumber, {RAW} AS raw FROM lineitem) SELECT l_orderkey, l_linenumber, raw, CAST(TRY_CAST(regexp_replace(replace(trim(raw), ',', ''), '(?i)\\s*min\\s*$', '') AS DECIMAL(38, 6)) AS DOUBLE) AS value FROM r")
def q_numeric_sanitize(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.expr(RAW.replace("VARCHAR", "STRING")).alias("raw"))
    return rows.withColumn("value", clean.sanitize(F.col("raw"), numeric=True).cast("double"))


def _profile_sql(cols: dict[str, str]) -> str:
    part = "SELECT '{n}' AS column_name, count(*) FILTER (WHERE trim(v) NOT IN ('', '-')) AS meaningful, count(TRY_CAST(regexp_replace(replace(trim(v), ',', ''), '(?i)\\s*min\\s*$', '') AS DECIMAL(38, 6))) FILTER (WHERE trim(v) NOT IN ('', '-')) AS numeric FROM (SELECT {e} AS v FROM events)"
    return "SELECT *, CASE WHEN meaningful > 0 AND meaningful = numeric THEN 'NUMERIC' ELSE 'TEXT' END AS inferred FROM (" + " UNION ALL ".join(part.format(n=n, e=e) for n, e in cols.items()) + ")"


PROFILED = {"event_id": "CAST(event_id AS VARCHAR)", "kind": "event_type", "props": "props", "dashes": "CASE WHEN user_id % 2 = 0 THEN '-' ELSE '' END", "mixed": "CASE WHEN user_id % 2 = 0 THEN '-' ELSE CAST(user_id AS VARCHAR) || ' min' END"}


@query(_profile_sql(PROFILED))
def q_type_inference(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(*[F.expr(e.replace("VARCHAR", "STRING")).alias(n) for n, e in PROFILED.items()])
    return profile.profile(rows, list(PROFILED))


@query("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 5 THEN NULL ELSE strftime(o_orderdate, '%Y') END AS year,
CASE o_orderkey % 6 WHEN 4 THEN NULL WHEN 5 THEN NULL ELSE strftime(o_orderdate, '%Y') END AS film_year FROM orders""")
def q_normalize_year(spark, sf_dir):
    y, d = F.date_format("o_orderdate", "yyyy"), F.date_format("o_orderdate", "yyyy-MM-dd")
    k = F.col("o_orderkey") % 6
    raw = F.when(k == 0, F.concat(F.lit("-"), y)).when(k == 1, F.concat(y, F.lit(".0"))).when(k == 2, F.concat(y, F.lit(" (India)"))).when(k == 3, d).when(k == 4, F.date_format("o_orderdate", "yyyyMMdd")).otherwise("19")
    return table(spark, sf_dir, "orders").select("o_orderkey", clean.normalize_year(raw).alias("year"), clean.film_year(raw).alias("film_year"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN dayname(o_orderdate) END AS release_day FROM orders")
def q_release_day(spark, sf_dir):
    k = F.col("o_orderkey") % 3
    raw = F.when(k == 0, F.concat(F.lit(" "), F.date_format("o_orderdate", "yyyy-MM-dd"))).when(k == 1, F.date_format("o_orderdate", "yyyy")).otherwise("2023-02-30")
    rows = columns.transform(table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("release_date")))
    return rows.select("o_orderkey", "release_day")


def _values(rows: list[tuple]) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(f"'{x}'" for x in r) + ")" for r in rows) + ")"


@query(f"SELECT doc_id, coalesce(v.name, trim(lang)) AS language FROM documents LEFT JOIN {_values(list(values.LANGUAGES.items()))} v(code, name) ON code = lower(trim(lang))")
def q_language_expand(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", clean.expand_language(F.col("lang")).alias("language"))


@query(f"SELECT doc_id, iso, country FROM documents LEFT JOIN {_values(values.resolver())} v(code, iso, country) ON code = lower(trim(lang))")
def q_country_resolve(spark, sf_dir):
    return enrich.country_of_language(table(spark, sf_dir, "documents"), "lang").select("doc_id", "iso", "country")


COUNTRY_NAMES = "CASE n_nationkey % 4 WHEN 0 THEN 'the ' || n_name WHEN 1 THEN 'Republic of Korea, South Korea' WHEN 2 THEN 'united' ELSE n_name END"


@query(f"""WITH n AS (SELECT n_nationkey, {COUNTRY_NAMES} AS name FROM nation), k AS (SELECT * FROM {_values(values.countries())} v(iso, country)),
m AS (SELECT n.*, iso, country, CASE WHEN lower(trim(name)) = lower(country) THEN 2 WHEN contains(lower(trim(name)), lower(country)) OR contains(lower(country), lower(trim(name))) THEN 1 END AS rank FROM n, k),
b AS (SELECT * FROM m WHERE rank IS NOT NULL QUALIFY row_number() OVER (PARTITION BY n_nationkey ORDER BY rank DESC, length(country) DESC, iso) = 1)
SELECT n.n_nationkey, n.name, b.iso, b.country FROM n LEFT JOIN b USING (n_nationkey)""")
def q_country_contains(spark, sf_dir):
    return enrich.country_of_name(table(spark, sf_dir, "nation").select("n_nationkey", F.expr(COUNTRY_NAMES).alias("name")), "name")


@query("""SELECT p_partkey, replace(p_name, ' ', '_') || '_' || CAST(1980 + p_partkey % 45 AS VARCHAR) AS slug, trim(p_name) AS name, CAST(1980 + p_partkey % 45 AS VARCHAR) AS year,
regexp_replace(regexp_replace(p_name, '[^A-Za-z0-9]+', '_', 'g'), '^_|_$', '', 'g') AS page FROM part""")
def q_slug_name_year(spark, sf_dir):
    rows = table(spark, sf_dir, "part").withColumn("slug", F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"), (1980 + F.col("p_partkey") % 45).cast("string")))
    return rows.select("p_partkey", "slug", clean.slug_name(F.col("slug")).alias("name"), clean.slug_year(F.col("slug")).alias("year"), clean.filmography_slug(F.col("p_name")).alias("page"))


@query("""WITH s AS (SELECT c_custkey, regexp_replace(c_name, '[^A-Za-z0-9]+', '_', 'g') AS slug FROM customer)
SELECT c_custkey, slug, CASE WHEN substr(slug, length(slug) - 1, 1) <> substr(slug, length(slug), 1) AND substr(slug, length(slug) - 1, 1) <> '_' AND substr(slug, length(slug), 1) <> '_'
THEN left(slug, length(slug) - 2) || substr(slug, length(slug), 1) || substr(slug, length(slug) - 1, 1) END AS variant FROM s""")
def q_typo_variant(spark, sf_dir):
    slug = clean.filmography_slug(F.col("c_name"))
    return table(spark, sf_dir, "customer").select("c_custkey", slug.alias("slug"), clean.typo_slug(slug).alias("variant"))


@query("SELECT l_orderkey, l_linenumber, CASE l_linenumber % 5 WHEN 0 THEN NULL WHEN 1 THEN 120 + CAST(l_quantity AS INTEGER) WHEN 2 THEN 100 + CAST(l_quantity AS INTEGER) WHEN 3 THEN 142 ELSE NULL END AS minutes FROM lineitem")
def q_runtime_parse(spark, sf_dir):
    k, q = F.col("l_linenumber") % 5, F.col("l_quantity").cast("int")
    raw = F.when(k == 0, "N/A").when(k == 1, F.concat(F.lit("2h "), q.cast("string"), F.lit("m"))).when(k == 2, F.concat((q + 100).cast("string"), F.lit(" mins"))).when(k == 3, "142").otherwise("0m")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", clean.runtime_minutes(raw).alias("minutes"))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'Released' WHEN 1 THEN 'Upcoming' ELSE CASE WHEN CAST(o_orderdate AS DATE) > DATE '1995-06-17' THEN 'Upcoming' ELSE 'Released' END END AS status FROM orders")
def q_status(spark, sf_dir):
    k = F.col("o_orderkey") % 4
    label = F.when(k == 0, "Released 2 days ago").when(k == 1, "Releasing soon").when(k == 2, "Soon")
    return table(spark, sf_dir, "orders").select("o_orderkey", clean.status(label, F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("1995-06-17").cast("date")).alias("status"))


# Unpivoting and merging


@query("SELECT l_orderkey, 'S' || CAST(max(l_suppkey) AS VARCHAR) AS actor_name, l_linenumber AS role_position FROM lineitem WHERE l_linenumber <= 3 GROUP BY l_orderkey, l_linenumber")
def q_unpivot_roles(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(*[F.max(F.when(F.col("l_linenumber") == i, F.col("l_suppkey"))).alias(f"Actor {i}") for i in (1, 2, 3)])
    rows = rows.select("l_orderkey", *[F.concat(F.lit("S"), F.col(f"Actor {i}").cast("string")).alias(f"Actor {i}") for i in (1, 2, 3)])
    return cast.unpivot(rows, columns.cast_headers(rows.columns).actors, [F.col("l_orderkey")])


STORED = f"{TITLES}, e AS (SELECT movie_name, year, language, revenue, budget FROM titles WHERE ord % 2 = 1 QUALIFY row_number() OVER (PARTITION BY movie_name, year ORDER BY ord) = 1), i AS (SELECT * FROM titles WHERE ord % 2 = 0)"


def _stored(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    t = titles(spark, sf_dir)
    old = match.top_one(t.where("ord % 2 = 1"), ["movie_name", "year"], F.asc("ord")).select("movie_name", "year", "language", "revenue", "budget")
    return old, t.where("ord % 2 = 0")


def _upsert(rule: str, sf_dir: str, spark: SparkSession) -> DataFrame:
    old, new = _stored(spark, sf_dir)
    return merge.merge(old, new, ["movie_name", "year"], {c: rule for c in ("language", "revenue", "budget")}, "ord")


def _upsert_sql(reduce: str, choose: str) -> str:
    n = ", ".join(reduce.format(c=c) for c in ("language", "revenue", "budget"))
    out = ", ".join(f"{choose.format(c=c)} AS {c}" for c in ("language", "revenue", "budget"))
    return f"WITH {STORED}, n AS (SELECT movie_name, year, {n} FROM i GROUP BY 1, 2) SELECT coalesce(e.movie_name, n.movie_name) AS movie_name, coalesce(e.year, n.year) AS year, {out} FROM e FULL OUTER JOIN n ON e.movie_name = n.movie_name AND e.year = n.year"


@query(_upsert_sql("arg_max_null({c}, ord) AS {c}", "CASE WHEN n.movie_name IS NOT NULL THEN n.{c} ELSE e.{c} END"))
def q_upsert_overwrite(spark, sf_dir):
    return _upsert("overwrite", sf_dir, spark)


@query(_upsert_sql("arg_max({c}, ord) FILTER (WHERE {c} IS NOT NULL) AS {c}", "coalesce(n.{c}, e.{c})"))
def q_upsert_new_first(spark, sf_dir):
    return _upsert("new_then_old", sf_dir, spark)


@query(_upsert_sql("arg_min({c}, ord) FILTER (WHERE {c} IS NOT NULL) AS {c}", "coalesce(e.{c}, n.{c})"))
def q_upsert_old_first(spark, sf_dir):
    return _upsert("old_then_new", sf_dir, spark)


FILMS = f"{TITLES}, f AS (SELECT ord, movie_name, release_date, year, CASE WHEN ord % 7 = 0 THEN -1.0 ELSE revenue END AS revenue, CAST(budget AS DOUBLE) AS budget FROM titles)"


def _films(spark, sf_dir) -> DataFrame:
    revenue = F.when(F.col("ord") % 7 == 0, -1.0).otherwise(F.col("revenue"))
    return titles(spark, sf_dir).select("ord", "movie_name", "release_date", revenue.alias("revenue"), F.col("budget").cast("double").alias("budget"))


def _updates(spark, sf_dir, n: int) -> DataFrame:
    t = titles(spark, sf_dir).where(f"ord % {n} = 1")
    return t.select("movie_name", "year", F.when(F.col("ord") % 5 != 0, F.col("ord") * 10.0).alias("revenue"), (F.col("ord") * 2.0).alias("budget"), "ord")


def _updates_sql(name: str, n: int, useful: str) -> str:
    return f"{name} AS (SELECT movie_name, year, arg_min(r, ord) FILTER (WHERE r {useful}) AS nr, arg_min(b, ord) FILTER (WHERE b {useful}) AS nb FROM (SELECT movie_name, year, ord, CASE WHEN ord % 5 <> 0 THEN ord * 10.0 END AS r, ord * 2.0 AS b FROM titles WHERE ord % {n} = 1) GROUP BY 1, 2)"


def _filled(source: str, n: str, test: str) -> str:
    return f"SELECT s.ord, s.movie_name, s.release_date, s.year, CASE WHEN coalesce(s.revenue, 0) {test} 0 THEN coalesce(n.nr, s.revenue) ELSE s.revenue END AS revenue, CASE WHEN coalesce(s.budget, 0) {test} 0 THEN coalesce(n.nb, s.budget) ELSE s.budget END AS budget FROM {source} s LEFT JOIN {n} n ON n.movie_name = s.movie_name AND n.year = s.year"


@query(f"WITH {FILMS}, {_updates_sql('n', 2, '> 0')} SELECT ord, movie_name, release_date, revenue, budget FROM ({_filled('f', 'n', '<=')})")
def q_gapfill_nonpositive(spark, sf_dir):
    return gapfill.apply(_films(spark, sf_dir), _updates(spark, sf_dir, 2), {"revenue": "if_nonpositive", "budget": "if_nonpositive"})


@query(f"WITH {FILMS}, {_updates_sql('n', 2, '<> 0')} SELECT ord, movie_name, release_date, revenue, budget FROM ({_filled('f', 'n', '=')})")
def q_gapfill_zero(spark, sf_dir):
    return gapfill.apply(_films(spark, sf_dir), _updates(spark, sf_dir, 2), merge.FILMS_FROM_OTHERS)


@query(f"WITH {FILMS}, {_updates_sql('n1', 9, '> 0')}, {_updates_sql('n2', 4, '<> 0')}, {_updates_sql('n3', 2, '<> 0')}, s1 AS ({_filled('f', 'n1', '<=')}), s2 AS ({_filled('s1', 'n2', '=')}) SELECT ord, movie_name, release_date, revenue, budget FROM ({_filled('s2', 'n3', '=')})")
def q_source_priority(spark, sf_dir):
    films = gapfill.apply(_films(spark, sf_dir), _updates(spark, sf_dir, 9), {"revenue": "if_nonpositive", "budget": "if_nonpositive"})
    for n in (4, 2):
        films = gapfill.apply(films, _updates(spark, sf_dir, n), merge.FILMS_FROM_OTHERS)
    return films


@query(f"""WITH {TITLES}, k AS (SELECT lower(trim(movie_name)) AS n, year, min(language) AS language FROM titles WHERE ord % 3 = 0 AND coalesce(language, '') NOT IN ('', 'Unknown') GROUP BY 1, 2)
SELECT ord, t.movie_name, release_date, CASE WHEN ord % 2 = 0 THEN t.language ELSE k.language END AS language FROM titles t LEFT JOIN k ON k.n = lower(trim(t.movie_name)) AND k.year = left(t.release_date, 4)""")
def q_language_fill(spark, sf_dir):
    t = titles(spark, sf_dir)
    rows = t.select("ord", "movie_name", "release_date", F.when(F.col("ord") % 2 == 0, F.col("language")).alias("language"))
    return cast.fill_language(rows, t.where("ord % 3 = 0")).select("ord", "movie_name", "release_date", "language")


@query(f"WITH {TITLES} SELECT ord, CASE WHEN coalesce(CASE WHEN ord % 3 = 0 THEN 0 ELSE budget END, 0) <> 0 THEN coalesce(nullif(revenue, 0), nullif(CAST(budget AS DOUBLE), 0), 0) ELSE revenue END AS revenue FROM titles")
def q_column_merge(spark, sf_dir):
    rows = titles(spark, sf_dir).select("ord", "revenue", F.when(F.col("ord") % 3 == 0, 0.0).otherwise(F.col("budget").cast("double")).alias("worldwide"))
    return merge.merge_columns(rows, "worldwide", "revenue")


@query(f"WITH {TITLES} SELECT count(*) FILTER (WHERE ord % 5 <> 0) AS processed, count(*) FILTER (WHERE ord % 5 = 0) AS skipped FROM titles")
def q_import_counters(spark, sf_dir):
    name = F.when(F.col("ord") % 5 == 0, " - ").otherwise(F.col("movie_name"))
    return titles(spark, sf_dir).agg(F.count_if(clean.meaningful(name)).alias("processed"), F.count_if(~clean.meaningful(name)).alias("skipped"))


# Rates, indicators, events


@query("""WITH r AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderkey % 2 = 0),
o AS (SELECT o_orderkey, o_totalprice / 1000 AS crore, CASE WHEN o_orderkey % 3 <> 0 AND CAST(o_orderdate AS DATE) <= DATE '1996-01-01' THEN CAST(o_orderdate AS DATE) ELSE DATE '1996-01-01' END AS d FROM orders)
SELECT o_orderkey, CAST(floor(crore * 1e7 * (0.01 + dayofyear(r.d) / 100000.0::DOUBLE) + 0.5) AS BIGINT) AS usd FROM o LEFT JOIN r USING (d)""")
def q_fx_convert(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    rates = orders.where("o_orderkey % 2 = 0").select(day.alias("rate_date")).distinct().select("rate_date", F.lit("INR").alias("from_currency"), F.lit("USD").alias("to_currency"), (F.lit(0.01) + F.dayofyear("rate_date") / F.lit(100000.0)).alias("rate"), F.lit(0).alias("fetched_at"))
    date = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    rows = enrich.with_rate(orders.withColumn("release_date", date), "release_date", rates, F.lit("1996-01-01").cast("date"))
    return rows.select("o_orderkey", clean.crore_to_usd(F.col("o_totalprice") / 1000, F.col("rate")).alias("usd"))


@query("SELECT l_orderkey, l_linenumber, floor((l_extendedprice - 30000) / 8 * 100 + 0.5) / 100 AS scaled FROM lineitem")
def q_indicator_scale(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", clean.scaled_indicator(F.col("l_extendedprice") - 30000, 8).alias("scaled"))


@query("SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS value FROM events")
def q_indicator_json(spark, sf_dir):
    body = F.when(F.col("event_id") % 5 == 0, F.lit('[{"page":1}]')).otherwise(F.concat(F.lit('[{"page":1},[{"value":'), F.get_json_object("props", "$.k"), F.lit("}]]")))
    return table(spark, sf_dir, "events").select("event_id", extract.indicator_value(body).alias("value"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN event_type ELSE 'None' END AS event_type, CASE event_id % 3 WHEN 2 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS event_name FROM events")
def q_event_json(spark, sf_dir):
    k = F.col("event_id") % 3
    name = F.concat(F.lit('"event_name":"'), F.col("user_id").cast("string"), F.lit('"'))
    body = F.when(k == 0, F.concat(F.lit('```json\n{"event_type":"'), "event_type", F.lit('",'), name, F.lit("}\n```"))).when(k == 1, F.concat(F.lit("{"), name, F.lit("}"))).otherwise('{"event_type":"null","event_name":"null"}')
    e = extract.event(body)
    return table(spark, sf_dir, "events").select("event_id", e["event_type"].alias("event_type"), e["event_name"].alias("event_name"))


@query("SELECT DISTINCT CAST(o_orderdate AS DATE) AS rate_date FROM orders WHERE o_orderkey % 2 = 0 EXCEPT SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderkey % 2 = 1")
def q_left_anti_new_rates(spark, sf_dir):
    pair = lambda k: table(spark, sf_dir, "orders").where(f"o_orderkey % 2 = {k}").select(F.col("o_orderdate").cast("date").alias("rate_date"), F.lit("INR").alias("from_currency"), F.lit("USD").alias("to_currency")).distinct()
    return enrich.new_rates(pair(0), pair(1)).select("rate_date")


# Filmographies

CAST_SQL = "FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey"


def _cast(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    date = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(F.col("c_name").alias("actor_name"), F.col("p_name").alias("movie_name"), date.alias("release_date"), F.col("l_linenumber").alias("role_position"))


DATE_SQL = "CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END"


@query(f"SELECT p_name AS movie_name, {DATE_SQL} AS release_date, l_linenumber AS role_position {CAST_SQL} WHERE lower(trim(c_name)) = 'customer#000000010' AND strftime(o_orderdate, '%Y') <= '1996' ORDER BY 2, 1")
def q_filmography(spark, sf_dir):
    return cast.filmography(_cast(spark, sf_dir), " Customer#000000010 ", "1996").select("movie_name", "release_date", "role_position")


@query(f"SELECT c_name AS actor_name, count(*) AS films, string_agg(p_name, '|' ORDER BY {DATE_SQL}, p_name) AS names {CAST_SQL} GROUP BY 1")
def q_filmography_counts(spark, sf_dir):
    return cast.filmography_counts(_cast(spark, sf_dir)).withColumn("names", F.array_join("names", "|"))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) = 1")
def q_top1_per_group(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return match.top_one(rows, ["l_orderkey"], F.desc("l_extendedprice"), F.asc("l_linenumber"))


# Pages


@query("""WITH i AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>', 1)) AS item FROM pages)
SELECT page_id, regexp_extract(item, '(?i)href=[''"]([^''"]*)[''"]', 1) AS href, trim(regexp_replace(item, '<[^>]+>', '', 'g')) AS text FROM i
WHERE regexp_extract(item, '(?i)href=[''"]([^''"]*)[''"]', 1) <> '' AND trim(regexp_replace(item, '<[^>]+>', '', 'g')) NOT IN ('', '-')""")
def q_html_list_items(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("body"))
    return page_ops.list_items(rows, ["page_id"]).select("page_id", "href", "text")


LINK = '<a[^>]*href="([^"]*)"[^>]*>([^<]*)</a>'


@query(f"WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '{LINK}', 1)) AS href, unnest(regexp_extract_all(html, '{LINK}', 2)) AS label FROM pages) SELECT page_id, href, trim(label) AS label FROM l")
def q_html_links(spark, sf_dir):
    return page_ops.links(table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("body")), LINK, ["page_id"]).drop("ord")


@query("SELECT page_id, md5(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', '', 'g'), '&amp;', '&'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')) AS text FROM pages")
def q_html_strip(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(clean.strip_tags(F.col("html"))).alias("text"))


def _detail_html(k: Column) -> Column:
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    card = F.when(k % 2 == 0, text(">Worldwide</div> <div class='x'>₹ 1,", k % 900 + 100, ".5 Cr </div>")).otherwise(text("Worldwide Collection ₹ ", k, ".25 Cr ##"))
    return text("<html>", F.rpad(F.lit(""), 200, " "), card, ">Budget:</span> <span>₹", k + 1, " Cr</span>>Genre:</span> <span>", F.when(k % 3 == 0, "N/A").otherwise("Action, Drama"), '</span>"@type":"Movie","genre":["Thriller","War"],"duration":"PT', F.when(k % 5 == 0, "").otherwise("1H"), k % 60, 'M","ratingValue": ', k % 10, ">Release Status:</span> <span>Released 2 days ago</span>")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN CAST('1' || CAST(p_partkey % 900 + 100 AS VARCHAR) || '.5' AS DOUBLE) ELSE p_partkey + 0.25::DOUBLE END AS worldwide_crore, CAST(p_partkey + 1 AS DOUBLE) AS budget_crore,
CASE WHEN p_partkey % 3 = 0 THEN 'Thriller, War' ELSE 'Action, Drama' END AS genre, CAST(CASE WHEN p_partkey % 5 = 0 THEN nullif(p_partkey % 60, 0) ELSE 60 + p_partkey % 60 END AS INTEGER) AS runtime, CAST(p_partkey % 10 AS DOUBLE) AS rating, 'Released' AS status FROM part""")
def q_detail_page(spark, sf_dir):
    fields = extract.detail_page(F.col("html"), F.lit("2024-01-01").cast("date"))
    rows = table(spark, sf_dir, "part").select("p_partkey", _detail_html(F.col("p_partkey")).alias("html"))
    return rows.select("p_partkey", *[fields[c].alias(c) for c in ("worldwide_crore", "budget_crore", "genre", "runtime", "rating", "status")])


@query("SELECT p_partkey, p_partkey * 1000 AS revenue_usd, p_partkey AS budget_usd, p_partkey + 0.5::DOUBLE AS worldwide_crore FROM part")
def q_other_sources(spark, sf_dir):
    k = F.col("p_partkey").cast("string")
    html = F.concat(F.rpad(F.lit(""), 200, " "), F.lit("Worldwide </b> <i>$"), k, F.lit(",000</i> Production Budget: $"), k, F.lit(" Worldwide Total Collection: Rs. "), k, F.lit(".5 Crore"))
    two, three = extract.source2_page(F.col("html")), extract.source3_page(F.col("html"))
    return table(spark, sf_dir, "part").select("p_partkey", html.alias("html")).select("p_partkey", two["revenue_usd"].alias("revenue_usd"), two["budget_usd"].alias("budget_usd"), three["worldwide_crore"].alias("worldwide_crore"))


@query("SELECT DISTINCT replace(p_name, ' ', '_') || '_' || CAST(1980 + p_partkey % 45 AS VARCHAR) AS slug, p_name AS name, CAST(1980 + p_partkey % 45 AS VARCHAR) AS year FROM part")
def q_sitemap_slugs(spark, sf_dir):
    loc = F.concat(F.lit("<loc>https://films.example/movie/"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"), (1980 + F.col("p_partkey") % 45).cast("string"), F.lit("</loc>"))
    maps = table(spark, sf_dir, "part").groupBy((F.col("p_partkey") % 20).alias("n")).agg(F.array_join(F.collect_list(loc), "\n").alias("body"))
    return page_ops.film_slugs(maps).select("slug", "name", "year").distinct()


@query("SELECT p_partkey AS ord, p_name AS movie_name, CAST(1981 + p_partkey % 40 AS VARCHAR) AS release_date, p_type AS language FROM part")
def q_html_table_rows(spark, sf_dir):
    row = F.concat(F.lit("<tr><th scope='row'>1</th><td><a href='/movie/X'>"), "p_name", F.lit("</a></td><td>"), (1981 + F.col("p_partkey") % 40).cast("string"), F.lit("</td><td>"), "p_type", F.lit("</td></tr>"))
    heads = "<table><tr><th scope='col'>Sr.</th><th scope='col'>Movie</th><th scope='col'>Year</th><th scope='col'>Language</th>"
    pages = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("url"), F.lit("a").alias("actor_name"), F.concat(F.lit(heads), row, F.lit("</table>")).alias("body"))
    return page_ops.table_rows(pages).select(F.col("url").cast("long").alias("ord"), "movie_name", "release_date", "language")


@query("SELECT n_nationkey, n_nationkey % 2 = 1 OR n_nationkey % 5 <> 0 AS allowed, CAST(CASE WHEN n_nationkey % 3 = 0 THEN 1000 ELSE n_nationkey * 1000 END AS BIGINT) AS delay_ms FROM nation")
def q_robots_gate(spark, sf_dir):
    k = F.col("n_nationkey")
    robots = F.concat(F.lit("User-agent: bot\nDisallow: /\nUser-Agent: *\n"), F.when(k % 2 == 0, "Disallow: /film/0\n").otherwise("Disallow:\n"), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("Crawl-delay: "), k.cast("string"))))
    rows = table(spark, sf_dir, "nation").select("n_nationkey", robots.alias("robots"), F.concat(F.lit("/film/"), (k % 5).cast("string")).alias("path"))
    return rows.select("n_nationkey", extract.path_allowed(F.col("robots"), F.col("path")).alias("allowed"), extract.crawl_delay_ms(F.col("robots")).alias("delay_ms"))


@query("SELECT event_type AS movie_name, CAST(CAST(ts AS DATE) AS VARCHAR) AS release_date, CAST(arg_max(event_id, event_id) AS DOUBLE) AS votes FROM events GROUP BY 1, 2")
def q_stream_folder(spark, sf_dir):
    """Events as CSV files in a folder, imported by the stream, read back from the store."""
    from reelgap.plans.imports import Settings
    from reelgap.sources.store import Store
    from reelgap.streaming.folder import watch_folder

    root = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("Title"), F.col("ts").cast("date").cast("string").alias("release_date"), F.col("event_id").alias("vote_count"))
    # a film's events are in one file, in order, so the last of each wins whatever the order of the files
    rows.repartition("Title", "release_date").sortWithinPartitions("vote_count").write.option("header", True).csv(f"{root}/in")
    store = Store(spark, f"{root}/store")
    stream = watch_folder(spark, store, f"{root}/in", f"{root}/ledger", Settings(fuzzy_max_pairs=None), once=True)
    stream.awaitTermination()
    return store.read("films").select("movie_name", "release_date", F.col("votes").cast("double").alias("votes"))


# The store, schema upkeep, and parts of the import


@query("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey % 2 = 0")
def q_store_snapshots(spark, sf_dir):
    """Two snapshots of one table; the pointer names the second."""
    from reelgap.sources.store import Store

    store, rows = Store(spark, f"{shared_dir(spark)}/store-{uuid.uuid4().hex}"), table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    store.write("nations", rows)
    store.write("nations", store.read("nations").where("n_nationkey % 2 = 0"))
    return store.read("nations")


@query("SELECT c_custkey, lower(trim(c_name)) || '|' || trim(c_mktsegment) AS merge_key, CASE WHEN c_custkey % 3 = 0 THEN 'none' ELSE trim(c_mktsegment) END AS shown FROM customer")
def q_merge_key(spark, sf_dir):
    padded = F.concat(F.lit(" \t"), F.upper("c_name"), F.lit(" "))
    blank = F.when(F.col("c_custkey") % 3 == 0, " ").otherwise(F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select("c_custkey", clean.merge_key(padded, F.col("c_mktsegment")).alias("merge_key"), clean.or_else(blank, "none").alias("shown"))


@query(f"WITH {TITLES} SELECT ord, replace(url_encode(movie_name || ' & Co ' || year), '%20', '+') AS search FROM titles")
def q_search_text(spark, sf_dir):
    return titles(spark, sf_dir).select("ord", gapfill.search_text(F.concat("movie_name", F.lit(" & Co")), F.col("year")).alias("search"))


@query(f"WITH {TITLES}, m AS (SELECT movie_name, left(release_date, 4) AS year, min(release_date) AS release_date FROM titles GROUP BY 1, 2) SELECT *, row_number() OVER (ORDER BY year, movie_name) AS place FROM m")
def q_movies_in_order(spark, sf_dir):
    """Places of the ordered films, counted by partition: a range sort and the partitions' sizes, no single task."""
    rows = gapfill.in_order(gapfill.movie_years(titles(spark, sf_dir).drop("year"))).withColumn("_id", F.monotonically_increasing_id())
    rows = rows.select("*", F.shiftright("_id", 33).alias("_part"), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_nth"))
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    later = sizes.select(F.col("_part").alias("_p"), "n")
    before = sizes.select("_part").join(later, F.col("_p") < F.col("_part"), "left").groupBy("_part").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("before"))
    return rows.join(F.broadcast(before), "_part").select("movie_name", "year", "release_date", (F.col("before") + F.col("_nth") + 1).alias("place"))


RATE = "CAST(o_orderdate AS DATE)"


@query(f"""WITH r AS (SELECT {RATE} AS rate_date, arg_max(round(o_totalprice / 1000, 3), o_orderkey) AS old FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1),
f AS (SELECT {RATE} AS rate_date, arg_max(round(o_totalprice / 2000, 3), o_orderkey) AS new FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1)
SELECT coalesce(r.rate_date, f.rate_date) AS rate_date, coalesce(new, old) AS rate, new IS NOT NULL AS fetched FROM r FULL JOIN f ON r.rate_date = f.rate_date""")
def q_latest_rates(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("rate_date"), F.lit("INR").alias("from_currency"), F.lit("USD").alias("to_currency"), "o_totalprice")
    old = o.where("o_orderkey % 2 = 0").groupBy("rate_date", "from_currency", "to_currency").agg(F.max_by(F.round(F.col("o_totalprice") / 1000, 3), "o_orderkey").alias("rate"), F.lit("2020-01-01").cast("timestamp").alias("fetched_at"))
    new = o.where("o_orderkey % 3 = 0").withColumn("rate", F.round(F.col("o_totalprice") / 2000, 3)).withColumn("fetched_at", F.lit("2024-01-01").cast("timestamp"))
    rows = merge.latest_rates(old, new, "o_orderkey")
    return rows.select("rate_date", "rate", (F.year("fetched_at") == 2024).alias("fetched"))


@query("SELECT c_custkey, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_acctbal + 1 END, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal END) AS revenue FROM customer")
def q_coalesce_update(spark, sf_dir):
    """A plain update: the new value where there is one, else the old; no rows are added."""
    c = table(spark, sf_dir, "customer")
    old = c.select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal")).alias("revenue"))
    new = c.where("c_custkey % 2 = 0").select("c_custkey", (F.col("c_acctbal") + 1).alias("revenue")).union(c.select(-1 - F.col("c_custkey"), "c_acctbal"))
    return merge.merge(old, new, ["c_custkey"], {"revenue": "new_then_old"}, "c_custkey", insert=False)


@query("""WITH f AS (SELECT p_name AS movie_name, CAST(1980 + p_partkey % 45 AS VARCHAR) AS release_date, CASE WHEN p_partkey % 2 = 0 THEN 'Unknown' ELSE p_brand END AS language, p_partkey % 5 AS votes, CASE WHEN p_partkey % 4 = 0 THEN p_size ELSE p_partkey % 3 END AS revenue FROM part)
SELECT movie_name, release_date, language, max(revenue) AS revenue, 0 AS budget, count(*) AS n FROM (SELECT movie_name, release_date, language, revenue FROM f) GROUP BY 1, 2, 3 HAVING count(*) = 1""")
def q_upkeep(spark, sf_dir):
    """A legacy column renamed, an alias merged, crawled columns added, language made part of the key."""
    from reelgap.plans import cycles

    k = F.col("p_partkey")
    films = table(spark, sf_dir, "part").select(F.col("p_name").alias("movie_name"), (1980 + k % 45).cast("string").alias("release_date"), F.when(k % 2 == 0, F.when(k % 3 == 0, "")).otherwise(F.col("p_brand")).alias("language"), F.when(k % 4 == 0, 0).otherwise(k % 3).alias("gross"), F.when(k % 4 == 0, F.col("p_size")).otherwise(0).alias("worldwide"))
    out = cycles.upkeep(films, {"gross": "revenue"}, {"worldwide": "revenue"})
    copies = merge.default_language(films).groupBy("movie_name", "release_date", "language").agg(F.count(F.lit(1)).alias("n"))
    return out.join(copies.where("n = 1"), ["movie_name", "release_date", "language"]).select("movie_name", "release_date", "language", F.col("revenue").cast("long").alias("revenue"), F.col("budget").cast("int").alias("budget"), "n")


# Search results, page guards and whole pages


@query("""SELECT p_partkey, '/title/tt' || p_partkey AS href, CAST(1980 + p_partkey % 45 AS VARCHAR) AS year, p_name AS name FROM part
UNION ALL SELECT p_partkey, '/releasegroup/gr' || p_partkey, NULL, 'Other' FROM part WHERE p_partkey % 2 = 0""")
def q_search_results2(spark, sf_dir):
    k, text = F.col("p_partkey"), lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    body = text('<a href="/title/tt', k, '" class="x">', F.col("p_name"), " (", 1980 + k % 45, ')</a><a href="/name/nm1">No</a>', F.when(k % 2 == 0, text('<a href="/releasegroup/gr', k, '">Other</a>')).otherwise(""))
    return page_ops.source2_candidates(table(spark, sf_dir, "part").select("p_partkey", body.alias("body")), ["p_partkey"]).select("p_partkey", "href", "year", "name")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'https://x.example/n/a-collection-' || (1980 + p_partkey % 45) ELSE 'https://x.example/box-office/f' || p_partkey END AS href,
CASE WHEN p_partkey % 3 = 0 THEN 'a collection ' || (1980 + p_partkey % 45) ELSE p_name END AS name, CASE WHEN p_partkey % 3 = 0 THEN CAST(1980 + p_partkey % 45 AS VARCHAR) END AS year FROM part WHERE p_partkey < 1900 OR p_partkey > 2100""")
def q_search_results3(spark, sf_dir):
    """Labelled articles, or links to collections on pages without any; one host only."""
    k, text = F.col("p_partkey"), lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    body = F.when(k % 3 == 0, text('<a href="https://x.example/n/a-collection-', 1980 + k % 45, '"><img></a>')).otherwise(text('<a href="https://x.example/box-office/f', k, '">', F.col("p_name"), ' Total Box Office Collection</a>'))
    body = text('<a href="https://other.example/box-office/no">No</a>', body)
    pages = table(spark, sf_dir, "part").where("p_partkey < 1900 or p_partkey > 2100").select("p_partkey", body.alias("body"))
    rows = page_ops.source3_candidates(pages, ["p_partkey"], host="x.example")
    return rows.select("p_partkey", "href", "name", F.when(F.col("p_partkey") % 3 == 0, F.col("year")).alias("year"))


@query("SELECT p_partkey, p_partkey % 5 <> 0 AND p_partkey % 7 <> 0 AND p_partkey % 4 <> 1 AS real FROM part")
def q_page_guards(spark, sf_dir):
    """Too short, not a list, or somebody else's; titles of another form aren't compared."""
    k = F.col("p_partkey")
    body = F.concat(
        F.lit('<meta property="og:url" data-x="1" content="https://x/news/'), F.when(k % 5 == 0, "Home").otherwise("List_Of_All_A_Movies"),
        F.when(k % 4 == 1, '"><meta property="og:title" content="List Of All Somebody Quite Else Movies | x">').when(k % 4 == 2, '"><meta property="og:title" content="List Of All Ann Lee Movies | x">').otherwise('"><meta property="og:title" content="Films">'),
        F.when(k % 7 == 0, "").otherwise(F.rpad(F.lit(""), 500, " ")),
    )
    return table(spark, sf_dir, "part").select("p_partkey", page_ops.is_filmography(body, F.lit("Ann Lee")).alias("real"))


@query("""SELECT s_suppkey AS actor, CASE WHEN s_suppkey % 2 = 0 THEN 'https://x/news/List_Of_All_Supplier_' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') || '_Movies_9' ELSE 'https://x/news/List_Of_All_Supplier_' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') || '_Movies' END AS url FROM supplier""")
def q_actor_urls(spark, sf_dir):
    """The page of a sitemap where one has the name, else the page that the name gives."""
    from reelgap.plans import cycles

    s = table(spark, sf_dir, "supplier")
    slug = F.regexp_replace("s_name", "#", "_")
    maps = s.where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("ord"), F.concat(F.lit("<loc>https://x/news/List_Of_All_"), slug, F.lit("_Movies_9</loc>")).alias("body"))
    work = cycles.actor_work(s.select(F.col("s_name").alias("actor_name")), page_ops.actor_pages(maps, host="x"), "https://x", 1.0)
    return work.select(F.regexp_extract("actor_name", "[0-9]+", 0).cast("long").alias("actor"), "url")


@query("""SELECT n_nationkey AS k, CASE n_nationkey % 3 WHEN 0 THEN 'direct' WHEN 1 THEN 'typo' END AS movie_name FROM nation WHERE n_nationkey % 3 < 2""")
def q_typo_pages(spark, sf_dir):
    """Films of the direct page, of the misspelt page where that has none, else none."""
    from reelgap.plans import cycles

    k = F.col("n_nationkey")
    n = table(spark, sf_dir, "nation").select(k, F.concat(F.lit("A"), k.cast("string")).alias("actor_name"), F.concat(F.lit("d"), k.cast("string")).alias("url"), F.concat(F.lit("t"), k.cast("string")).alias("typo_url"))
    page = lambda name: F.concat(F.lit('"og:url" content="List_Of_All"'), F.rpad(F.lit(""), 500, " "), F.lit(f"<table><tr><td>1</td><td>{name}</td><td>2001</td></tr></table>"))
    fetched = n.where(k % 3 == 0).select("url", page("direct").alias("body")).union(n.where(k % 3 < 2).select("typo_url", page("typo")))
    return cycles.filmographies(n.drop("n_nationkey"), fetched).select(F.substring("actor_name", 2, 9).cast("long").alias("k"), "movie_name")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'Festival' ELSE 'None' END AS event_type, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS event_name, CAST(c_custkey % 100 AS DOUBLE) / 4 AS indicator FROM customer""")
def q_responses(spark, sf_dir):
    k = F.col("c_custkey")
    event = F.when(k % 3 == 0, F.concat(F.lit('```json\n{"event_type": "Festival", "event_name": "'), "c_mktsegment", F.lit('"}\n```'))).when(k % 3 == 1, '{"event_name": "null"}').otherwise("no JSON")
    indicator = F.concat(F.lit('[{"page": 1}, [{"value": '), (k % 100 / 4).cast("string"), F.lit("}]]"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", extract.event(event).alias("e"), extract.indicator_value(indicator).alias("indicator"))
    return rows.select("c_custkey", "e.event_type", "e.event_name", "indicator")


@query("""SELECT p_partkey AS ord, CAST(CASE WHEN p_partkey % 2 = 0 THEN p_partkey % 50 + 0.5 END AS DOUBLE) AS gdp_usd_billions, CASE WHEN p_partkey % 3 = 0 THEN 'Festival' END AS release_event_type
FROM part""")
def q_enrich(spark, sf_dir):
    """Indicators of country and year, events of day and country."""
    k = F.col("p_partkey")
    films = table(spark, sf_dir, "part").select(k.alias("ord"), F.concat((1950 + k % 50).cast("string"), F.when(k % 3 == 0, "-01-01").otherwise("")).alias("release_date"), F.when(k % 2 == 0, "hi").otherwise("xx").alias("language"), F.when(k % 2 == 0, F.lit(None)).when(k % 3 == 0, "India").cast("string").alias("country"))
    years = spark.range(50).select(F.lit("IN").alias("iso"), (1950 + F.col("id")).cast("int").alias("year"), F.lit("gdp").alias("indicator"), F.concat(F.lit('[{}, [{"value": '), (F.col("id") * 1000000000 + 500000000).cast("string"), F.lit("}]]")).alias("body"))
    events = spark.range(50).select(F.concat((1950 + F.col("id")).cast("string"), F.lit("-01-01")).alias("date"), F.lit("India").alias("country"), F.lit('{"event_type": "Festival"}').alias("body"))
    out = enrich.enrich(films, "release_date", "language", "country", years, events)
    odd = (F.col("ord") % 2 == 1) & (F.col("ord") % 3 == 0)  # an explicit country has indicators as well
    return out.select("ord", F.when(~odd, F.col("gdp_usd_billions")).alias("gdp_usd_billions"), "release_event_type")


@query("""SELECT 'offered' AS counter, count(*) AS n FROM part UNION ALL SELECT 'no_data', count(*) FROM part WHERE p_partkey % 4 = 0
UNION ALL SELECT 'matched_rows', count(*) FROM part WHERE p_partkey % 4 <> 0 AND p_partkey % 5 <> 0 UNION ALL SELECT 'changed_rows', count(*) FROM part WHERE p_partkey % 4 <> 0 AND p_partkey % 5 <> 0 AND p_partkey % 3 = 0""")
def q_cycle_counters(spark, sf_dir):
    """What a source offered, had no data for, matched (unchanged rows too) and changed."""
    from reelgap.plans import cycles

    k = F.col("p_partkey")
    films = table(spark, sf_dir, "part").where(k % 5 != 0).select(k.cast("string").alias("movie_name"), F.lit("2001").alias("release_date"), F.when(k % 3 == 0, 0.0).otherwise(1.0).alias("revenue"), F.lit(1.0).alias("budget"))
    offered = table(spark, sf_dir, "part").select(k.cast("string").alias("movie_name"), F.lit("2001").alias("year"), k.alias("ord"), F.when(k % 4 != 0, 7.0).alias("revenue"), F.lit(None).cast("double").alias("budget"))
    counted = cycles.counters(films, gapfill.apply(films, offered, merge.FILMS_FROM_OTHERS), offered)
    return spark.createDataFrame(list(counted.items()), "counter string, n long")


@query("""SELECT p_partkey, coalesce(CASE WHEN p_partkey % 2 = 0 THEN 2000 END = CASE WHEN p_partkey % 3 = 0 THEN 2000 WHEN p_partkey % 3 = 1 THEN 2001 END, true) AS fits,
CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE p_name || ' 7' END AS name, CASE WHEN p_partkey % 2 = 0 THEN p_size || ' min.' ELSE CAST(p_size AS VARCHAR) END AS runtime FROM part""")
def q_small_rules(spark, sf_dir):
    """Years that may agree, names without a year in brackets, runtimes as text."""
    k = F.col("p_partkey")
    year = F.when(k % 2 == 0, 2000)
    return table(spark, sf_dir, "part").select(
        "p_partkey", match.compatible_years(year, F.when(k % 3 == 0, 2000).when(k % 3 == 1, 2001)).alias("fits"),
        clean.strip_paren_year(F.concat("p_name", F.when(k % 2 == 0, " (1999)").otherwise(" 7"))).alias("name"),
        clean.runtime_text(F.concat(F.col("p_size").cast("string"), F.when(k % 2 == 0, " min.").otherwise(" MIN "))).alias("runtime"),
    )

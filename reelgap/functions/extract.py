"""Extraction of fields from fetched pages and responses, as column expressions over the body."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelgap.functions.clean import amount, found, iso_duration, runtime_minutes, status, strip

# Fixed: the patterns of the pages' markup.
WORLDWIDE = [
    r"(?s)>Worldwide</div>\s*<div[^>]*>\s*₹\s*([\d,.]+)\s*Cr\s*</div>",
    r"₹\s*([\d,.]+)\s*Cr\s*</div>(?:[\s\S]{0,200}?)>Total Worldwide</div>",
    r"Worldwide(?:\s+Total(?:\s+Gross)?)?\s+Collection\s*₹\s*([\d,.]+)\s*Cr",
]
BUDGET = r"(?s)>Budget:</span>\s*<span[^>]*>\s*₹\s*([\d,.]+)\s*Cr\s*</span>"
LABELLED = r"(?s)>{}:</span>\s*<span[^>]*>\s*([^<]+?)\s*</span>"
JSON_ARRAY = r'"@type"\s*:\s*"Movie"[\s\S]{{0,600}}?"{}"\s*:\s*\[([^\]]+)\]'
DURATION = r'"duration"\s*:\s*"PT(?:(\d+)H)?(?:(\d+)M)?"'
USER_RATING = r'font-bold text-orange-600">([\d.]+)</span>'
REVIEW_RATING = r'"ratingValue"\s*:\s*([\d.]+)'
PUBLISHED = r'"@type"\s*:\s*"Movie"[\s\S]{0,600}?"datePublished"\s*:\s*"(\d{4}-\d{2}-\d{2})"'
SOURCE2_LINK = r'href="(/(?:releasegroup/gr|title/tt)[^"?#]*)"[^>]*>([^<]+)</a>'
SOURCE2_WORLDWIDE = r"Worldwide[\s\S]{0,2000}?\$([\d,]+)"
SOURCE2_BUDGET = r"Production Budget[\s\S]{0,800}?\$([\d,]+)"
SOURCE3_LINK = r'href="(https://{host}/box-office/[^"]+)"[^>]*>([^<]*)</a>'
SOURCE3_FALLBACK = r'href="(https://{host}/[^"]*(?:collection|box-office)[^"]*)"'
SOURCE3_WORLDWIDE = (
    r"(?i)(?:Total Worldwide|Worldwide Total|Total(?:\s+Box\s+Office)?|Lifetime(?:\s+Box\s+Office)?)"
    r"\s*(?:Box\s*Office\s*)?Collection\s*[:\-–]?\s*(?:Rs\.?|₹|INR)?\s*([\d,.]+)\s*(?:Crore|Cr\.?|cr)"
)
SOURCE3_BUDGET = r"(?i)(?:Production\s+|Film\s+|Made\s+on\s+a\s+)?Budget\s*[:\-–]?\s*(?:Rs\.?|₹|INR)?\s*([\d,.]+)\s*(?:Crore|Cr\.?|cr)"
MOVIE_SLUGS = r"<loc>https://{host}/movie/([A-Za-z0-9_]+)</loc>"
ACTOR_PAGES = r"<loc>(https://{host}/news/List_Of_All_([A-Za-z0-9_]+?)_Movies(?:_\d+)?)</loc>"
SUB_SITEMAP = r"<loc>(https://{host}/[^<]*sitemap[^<]*\.xml)</loc>"
OG_URL = r'"og:url"[^>]*content="([^"]+)"'
OG_TITLE = r'"og:title" content="List Of All ([^|"]+?) Movies'
ANY_HOST = r'[^<"/]+'
USD_RATE = r'"currency"\s*:\s*"USD"\s*,\s*"rate"\s*:\s*([0-9.]+)'
LIST_ITEM = r"(?is)<li[^>]*>(.*?)</li>"
HREF = r"(?i)href=['\"]([^'\"]*)['\"]"
CRAWL_DELAY = r"(?i)crawl-delay:\s*(\d+)"
EVENT = "event_type string, event_name string, event_detail string"


def at_host(pattern: str, host: str | None) -> str:
    """``pattern`` for one host, or for any."""
    return pattern.replace("{host}", re.escape(host) if host else ANY_HOST)


def first_of(body: Column, patterns: list[str]) -> Column:
    return F.coalesce(*[found(body, p) for p in patterns])


def all_pairs(body: Column, pattern: str) -> Column:
    """array<struct<href, label>> of a pattern with two groups, in document order."""
    return F.arrays_zip(F.regexp_extract_all(body, F.lit(pattern), F.lit(1)).alias("href"), F.regexp_extract_all(body, F.lit(pattern), F.lit(2)).alias("label"))


def named_list(html: Column, label: str, key: str) -> Column:
    """A labelled value, else the JSON array as comma-separated text."""
    shown = F.trim(found(html, LABELLED.format(label)))
    listed = F.trim(F.regexp_replace(F.regexp_replace(found(html, JSON_ARRAY.format(key)), '"', ""), r",\s*", ", "))
    return F.coalesce(F.when(~F.lower(shown).isin("", "n/a"), shown), F.nullif(listed, F.lit("")))


def detail_page(html: Column, as_of: Column) -> dict[str, Column]:
    """Measures of a film's page at the first source; all null for a body under 200 characters."""
    body = F.when(F.length(html) >= 200, html)
    matched = F.regexp_substr(body, F.lit(DURATION))
    return {
        "worldwide_crore": amount(first_of(body, WORLDWIDE)),
        "budget_crore": amount(found(body, BUDGET)),
        "genre": named_list(body, "Genre", "genre"),
        "language": named_list(body, "Languages?", "inLanguage"),
        "runtime": F.coalesce(iso_duration(found(matched, DURATION, 1), found(matched, DURATION, 2)), runtime_minutes(F.trim(found(body, LABELLED.format("Runtime"))))),
        "rating": F.coalesce(found(body, USER_RATING).try_cast("double"), found(body, REVIEW_RATING).try_cast("double")),
        "status": status(found(body, LABELLED.format("Release Status")), found(body, PUBLISHED), as_of),
    }


def source2_page(html: Column) -> dict[str, Column]:
    body = F.when(F.length(html) >= 200, html)
    return {"revenue_usd": amount(found(body, SOURCE2_WORLDWIDE), "long"), "budget_usd": amount(found(body, SOURCE2_BUDGET), "long")}


def source3_page(html: Column) -> dict[str, Column]:
    body = F.when(F.length(html) >= 200, html)
    return {"worldwide_crore": amount(found(body, SOURCE3_WORLDWIDE)), "budget_crore": amount(found(body, SOURCE3_BUDGET))}


def usd_rate(body: Column) -> Column:
    return found(body, USD_RATE).try_cast("double")


def indicator_value(body: Column) -> Column:
    return F.get_json_object(body, "$[1][0].value").try_cast("double")


def fenced(text: Column) -> Column:
    """What is inside a Markdown code fence, else the text."""
    return strip(F.coalesce(found(text, r"(?s)^\s*```[a-zA-Z]*\s*(.*?)\s*```"), text))


def event(text: Column) -> Column:
    """struct of an event response: a missing type is "None", the word null is null."""
    e = F.from_json(fenced(text), EVENT)
    plain = lambda c: F.when(F.lower(c) != "null", c)
    return F.struct(F.coalesce(plain(e["event_type"]), F.lit("None")).alias("event_type"), plain(e["event_name"]).alias("event_name"), plain(e["event_detail"]).alias("event_detail"))


def crawl_delay_ms(robots: Column) -> Column:
    return F.coalesce(found(robots, CRAWL_DELAY).try_cast("long") * 1000, F.lit(1000).cast("long"))


def path_allowed(robots: Column, path: Column) -> Column:
    """False if a Disallow line of the ``*`` group is a prefix of ``path``; the latest User-agent line names the group."""
    lines = F.transform(F.split(F.coalesce(robots, F.lit("")), r"\r?\n"), strip)
    start = F.struct(F.lit(False).alias("every"), F.lit(False).alias("hit"))
    value = lambda line: strip(F.regexp_replace(line, "^[^:]*:", ""))

    def step(s: Column, line: Column) -> Column:
        low, rule = F.lower(line), value(line)
        every = F.when(low.startswith("user-agent:"), rule == "*").otherwise(s["every"])
        hit = s["hit"] | (low.startswith("disallow:") & s["every"] & (rule != "") & F.startswith(path, rule))
        return F.struct(every.alias("every"), hit.alias("hit"))

    return ~F.aggregate(lines, start, step)["hit"]

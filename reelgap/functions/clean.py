"""Cleaning of text, numbers, dates and durations, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelgap.functions.values import LANGUAGES

DECIMAL = "decimal(38,6)"


def strip(c: Column) -> Column:
    """Without leading and trailing characters up to U+0020; Spark's own trim takes spaces only."""
    return F.regexp_replace(c, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def found(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null without one."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def blank_to_null(c: Column, extra: tuple[str, ...] = ()) -> Column:
    """Stripped; null if blank, a dash or one of ``extra`` in any case."""
    s = strip(c)
    return F.when(~F.lower(s).isin("", "-", *extra), s)


def numeric_text(c: Column) -> Column:
    """Without thousands separators and a closing "min"."""
    return F.regexp_replace(F.regexp_replace(c, ",", ""), r"(?i)\s*min\s*$", "")


def number(c: Column) -> Column:
    """A decimal, or null for what isn't one."""
    return numeric_text(blank_to_null(c)).try_cast(DECIMAL)


def sanitize(c: Column, numeric: bool) -> Column:
    return number(c) if numeric else blank_to_null(c)


def meaningful(c: Column) -> Column:
    return F.coalesce(blank_to_null(c).isNotNull(), F.lit(False))


def runtime_text(c: Column) -> Column:
    """A runtime that stays text, without a closing "min"."""
    return F.nullif(strip(F.regexp_replace(blank_to_null(c), r"(?i)\s*min\s*$", "")), F.lit(""))


def normalize_year(c: Column) -> Column:
    """``YYYY`` or ``YYYY-MM-DD``, else the first four digits; a leading dash and a decimal zero are dropped."""
    s = F.regexp_replace(F.regexp_replace(blank_to_null(c), "^-", ""), r"\.0+$", "")
    s = strip(s)
    return F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$") | s.rlike(r"^\d{4}$"), s).otherwise(found(s, r"(\d{4})"))


def film_year(c: Column) -> Column:
    """The first year from 1980 to 2039 that stands alone."""
    return found(c, r"\b((?:19[89]\d|20[0-3]\d))\b")


def iso_date(c: Column) -> Column:
    """A date, only from exactly ``YYYY-MM-DD``."""
    s = strip(c)
    return F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(s, "yyyy-MM-dd"))


def weekday(c: Column) -> Column:
    return F.date_format(iso_date(c), "EEEE")


def year_of(c: Column) -> Column:
    return F.substring(c, 1, 4)


def expand_language(c: Column) -> Column:
    """The language's name for a known code, else the text stripped."""
    pairs = F.create_map(*[F.lit(x) for kv in LANGUAGES.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, F.lower(strip(c))), strip(c))


def normalize_name(c: Column) -> Column:
    """Lower case, runs of anything but a-z and 0-9 as one space."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def merge_key(name: Column, date: Column) -> Column:
    return F.concat(F.lower(strip(name)), F.lit("|"), strip(date))


def slug_name(slug: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(slug, r"_\d{4}$", ""), "_", " "))


def slug_year(slug: Column) -> Column:
    return found(slug, r"_(\d{4})$")


def filmography_slug(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(name, "[^A-Za-z0-9]+", "_"), "^_|_$", "")


def typo_slug(slug: Column) -> Column:
    """The slug with its last two characters swapped; null if that changes nothing or moves an underscore."""
    n = F.length(slug)
    a, b = F.substr(slug, n - 1, F.lit(1)), F.substr(slug, n, F.lit(1))
    return F.when((n >= 2) & (a != "_") & (b != "_") & (a != b), F.concat(F.substr(slug, F.lit(1), n - 2), b, a))


def strip_tags(html: Column) -> Column:
    """Text without tags, with six entities decoded in this order, stripped; empty for null."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), "<[^>]+>", "")
    for entity, character in (("&amp;", "&"), ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")):
        text = F.replace(text, F.lit(entity), F.lit(character))
    return strip(text)


def strip_year_suffix(name: Column) -> Column:
    """A name without a closing four-digit year, unless nothing else is left."""
    return F.coalesce(F.nullif(strip(F.regexp_replace(name, r"\s*(\d{4})$", "")), F.lit("")), name)


def strip_paren_year(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"\(\d{4}\)", ""))


def strip_label_noise(c: Column) -> Column:
    """An article's label without the words that all such labels have."""
    return strip(F.regexp_replace(c, r"(?i)\s*(total|box\s*office|collection|week\s*\d+.*|day\s*\d+.*)\s*", " "))


def amount(c: Column, kind: str = "double") -> Column:
    return F.when(F.trim(F.replace(c, F.lit(","), F.lit(""))).rlike(r"^[0-9.]+$"), F.trim(F.replace(c, F.lit(","), F.lit(""))).try_cast(kind))


def iso_duration(hours: Column, minutes: Column) -> Column:
    total = F.coalesce(hours.try_cast("int"), F.lit(0)) * 60 + F.coalesce(minutes.try_cast("int"), F.lit(0))
    return F.when(total > 0, total)


def runtime_minutes(c: Column) -> Column:
    """Minutes of "2h 30m", "150 mins" or a plain number; null for none, zero and N/A."""
    total = F.coalesce(found(c, r"(\d+)\s*h").try_cast("int"), F.lit(0)) * 60 + F.coalesce(found(c, r"(\d+)\s*m(?:in)?").try_cast("int"), F.lit(0))
    total = F.when(total == 0, F.nullif(F.regexp_replace(c, "[^0-9]", ""), F.lit("")).try_cast("int")).otherwise(total)
    return F.when((F.lower(c) != "n/a") & (total > 0), total)


def status(text: Column, published: Column, as_of: Column) -> Column:
    """Released or Upcoming, from the label and else from the date."""
    t = F.lower(F.trim(text))
    named = F.when(t.contains("released") | t.contains("days ago") | t.contains("weeks ago"), "Released").when(t.contains("upcoming") | t.contains("releasing"), "Upcoming")
    date = iso_date(published)
    return F.coalesce(named, F.when(date.isNotNull(), F.when(date > as_of, "Upcoming").otherwise("Released")))


def crore_to_usd(crore: Column, rate: Column) -> Column:
    """Ten millions of rupees to dollars, halves up."""
    return F.floor(crore * 1e7 * rate + 0.5).cast("long")


def scaled_indicator(raw: Column, divisor: float) -> Column:
    """raw / divisor to two places, halves towards positive infinity."""
    return F.floor(raw / F.lit(float(divisor)) * 100 + 0.5) / F.lit(100.0)


def rate_date(release_date: Column, as_of: Column) -> Column:
    """The day whose exchange rate holds: that of a full date up to ``as_of``, else ``as_of``."""
    date = iso_date(F.substring(release_date, 1, 10))
    return F.when(date <= as_of, date).otherwise(as_of)


def or_else(c: Column, fallback: str) -> Column:
    return F.coalesce(F.nullif(strip(c), F.lit("")), F.lit(fallback))

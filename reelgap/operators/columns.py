"""Header mapping on the driver: what each column of a file becomes."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelgap.functions import clean, values

KEYS = ["movie_name", "release_date", "language"]


def column_name(header: str) -> str:
    h = header.strip().lower()
    if h in values.NAME_HEADERS:
        return "movie_name"
    if h in values.RENAMED_HEADERS:
        return values.RENAMED_HEADERS[h]
    slug = re.sub(r"[^a-z0-9]+", "_", h).strip("_")
    return values.RENAMED_SLUGS.get(slug, slug)


def mapping(headers: list[str]) -> dict[str, str]:
    """Column -> header that supplies it: the first in file order; skipped and blank headers have none."""
    out: dict[str, str] = {}
    for h in headers:
        if h.strip() and h.strip().lower() not in values.SKIPPED_HEADERS and column_name(h):
            out.setdefault(column_name(h), h)
    return out


def country_header(headers: list[str]) -> str | None:
    return next((h for h in headers if "country" in h.lower() or h.lower() == "production_countries"), None)


@dataclass
class CastHeaders:
    """Which header has which field of a cast file, and its actor headers in order."""

    fields: dict[str, str] = field(default_factory=dict)
    actors: list[str] = field(default_factory=list)

    @property
    def usable(self) -> bool:
        return "movie" in self.fields and "year" in self.fields and bool(self.actors)


def cast_headers(headers: list[str]) -> CastHeaders:
    """The first header of each field; numbered actor headers by number (the last of a number), then the others."""
    found, numbered, others = CastHeaders(), {}, []
    for h in headers:
        low = h.strip().lower()
        name = next((f for f, known in values.CAST_HEADERS.items() if f not in found.fields and low in known), None)
        if name:
            found.fields[name] = h
        elif m := re.match(values.ACTOR_HEADER, h.strip()):
            if m[1]:
                numbered[int(m[1])] = h
            else:
                others.append(h)
    found.actors = [numbered[n] for n in sorted(numbered)] + others
    return found


def transform(df: DataFrame) -> DataFrame:
    """Trimmed release_date with its weekday beside it, and expanded original_language; other columns as they are."""
    if "release_date" in df.columns:
        date = clean.strip(F.col("release_date"))
        day = F.when(date == "", F.col("release_day") if "release_day" in df.columns else F.lit(None).cast("string")).otherwise(clean.weekday(date))
        df = df.withColumn("release_day", day).withColumn("release_date", date)
    if "original_language" in df.columns:
        df = df.withColumn("original_language", clean.expand_language(F.col("original_language")))
    return df


def select_mapped(df: DataFrame, columns: dict[str, str], extra: list[str] = ()) -> DataFrame:
    return df.select(*[F.col(f"`{h}`").alias(c) for c, h in columns.items()], *extra)

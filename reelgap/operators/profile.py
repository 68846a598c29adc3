"""Column profiles, type inference and additive schema evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelgap.functions import clean, values

NUMERIC, TEXT = "NUMERIC", "TEXT"


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, meaningful, numeric, inferred) of all columns, from one pass over the rows."""
    counts = []
    for i, c in enumerate(columns):
        value = F.col(f"`{c}`").cast("string")
        counts += [F.count_if(clean.meaningful(value)).alias(f"m{i}"), F.count(clean.number(value)).alias(f"n{i}")]
    one = df.agg(*counts)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("meaningful"), F.col(f"n{i}").alias("numeric")) for i, c in enumerate(columns)])
    out = one.select(F.explode(rows).alias("r")).select("r.*")
    return out.withColumn("inferred", F.when((F.col("meaningful") > 0) & (F.col("meaningful") == F.col("numeric")), NUMERIC).otherwise(TEXT))


def infer(df: DataFrame, columns: list[str]) -> dict[str, str]:
    known = {c: NUMERIC for c in columns if c in values.KNOWN_NUMERIC}
    rest = [c for c in columns if c not in known]
    return known | ({r.column_name: r.inferred for r in profile(df, rest).collect()} if rest else {})


def is_numeric(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def spark_type(kind: str) -> str:
    return clean.DECIMAL if kind == NUMERIC else "string"


def evolve(existing: DataFrame, new: dict[str, str]) -> DataFrame:
    """``existing`` with the columns of ``new`` that it lacks: zero where numeric, null where text."""
    for c, kind in new.items():
        if c not in existing.columns:
            existing = existing.withColumn(c, F.lit(0 if kind == NUMERIC else None).cast(spark_type(kind)))
    return existing


def fill_absent(rows: DataFrame, schema: T.StructType, present: set[str]) -> DataFrame:
    """Rows to insert, in ``schema``'s columns; those that the batch lacks get their default."""
    out = []
    for f in schema.fields:
        default = F.lit(0 if is_numeric(f.dataType) else None).cast(f.dataType)
        out.append((F.col(f.name).cast(f.dataType) if f.name in present else default).alias(f.name))
    return rows.select(*out)


def rename_legacy(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new) if old in df.columns and new not in df.columns else df


CRAWLED_FILM_COLUMNS = {"revenue": NUMERIC, "budget": NUMERIC, "runtime": NUMERIC, "rating_10": NUMERIC, "genre": TEXT, "language": TEXT, "status": TEXT}
CRAWLED_CAST_COLUMNS = {"status": TEXT, "page_url": TEXT}

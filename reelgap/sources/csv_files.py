"""CSV files with any headers, as all-text rows in file order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelgap.functions.clean import strip

ORDER, FILE = "_ord", "_file"


def header(spark: SparkSession, path: str) -> list[str]:
    """The first record's cells, stripped."""
    rows = spark.read.option("header", False).option("multiLine", True).option("escape", '"').csv(path).limit(1).collect()
    return [(c or "").strip() for c in rows[0]] if rows else []


def read(spark: SparkSession, path: str, strict_short_rows: bool = False) -> DataFrame:
    """One file: trimmed text columns, the place of each row (_ord) and the file's path (_file).

    Blank headers are dropped and a repeated header keeps its first column. Long rows lose their extra cells; short
    rows get nulls, or fail with ``strict_short_rows``. Rows without any cell are skipped.
    """
    names = header(spark, path)
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("enforceSchema", True)
    if not names:
        return spark.createDataFrame([], f"{ORDER} long, {FILE} string")
    if strict_short_rows:
        reader = reader.option("mode", "FAILFAST")
    rows = reader.schema(schema).csv(path)
    first: dict[str, int] = {}
    for i, n in enumerate(names):
        if n:
            first.setdefault(n, i)
    rows = rows.where(F.coalesce(*[F.col(f"c{i}") for i in range(len(names))]).isNotNull()) if names else rows
    # a multi-line file is one partition, so these numbers follow its rows
    return rows.select(*[strip(F.col(f"c{i}")).alias(n) for n, i in first.items()], F.monotonically_increasing_id().alias(ORDER), F.lit(path).alias(FILE))


def listing_with_times(spark: SparkSession, folder: str, pattern: str = "*.[cC][sS][vV]") -> list[tuple]:
    """(path, length, modification time) of a folder's files that match, in lexicographic order; sub-folders aren't entered."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "length", "modificationTime")
    return sorted(map(tuple, found.collect()))


def listing(spark: SparkSession, folder: str, pattern: str = "*.[cC][sS][vV]") -> list[str]:
    """Paths of a folder's files that match, in lexicographic order."""
    return [path for path, *_ in listing_with_times(spark, folder, pattern)]

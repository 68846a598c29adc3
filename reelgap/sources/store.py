"""Keyed tables as Parquet snapshots with an atomically replaced pointer.

A write goes to a folder of its own; the pointer file that names the current one is replaced last. Readers see the
old or the new snapshot, never a part of one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_KINDS = {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(), "date": T.DateType(), "timestamp": T.TimestampType(), "number": T.DecimalType(38, 6)}


def _schema(text: str) -> T.StructType:
    """Fields as "name kind, ...", without a session."""
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in (f.split() for f in text.split(", "))])


FILMS = _schema("movie_name string, release_date string, language string")
CAST = _schema(
    "actor_name string, movie_name string, release_date string, language string, genre string, director string, rating number, votes number, runtime string, "
    "role_position int, character_name string, awards string, streaming_platform string, status string, page_url string"
)
RATES = _schema("rate_date date, from_currency string, to_currency string, rate double, fetched_at timestamp")


class Store:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def current(self, table: str) -> str | None:
        pointer = self._path(table, "CURRENT")
        fs = pointer.getFileSystem(self._conf)
        if not fs.exists(pointer):
            return None
        return self.spark.read.text(pointer.toString()).first()[0].strip()

    def exists(self, table: str) -> bool:
        return self.current(table) is not None

    def read(self, table: str, otherwise: T.StructType | None = None) -> DataFrame:
        """The current snapshot; an empty table of the schema ``otherwise`` where there is none."""
        name = self.current(table)
        if name is None:
            if otherwise is None:
                raise KeyError(f"no table {table}")
            return self.spark.createDataFrame([], otherwise)
        return self.spark.read.parquet(f"{self.root}/{table}/{name}")

    def columns(self, table: str) -> dict[str, str]:
        return dict(self.read(table, T.StructType([])).dtypes)

    def write(self, table: str, df: DataFrame) -> None:
        name = f"snapshot-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{table}/{name}")
        pointer, fresh = self._path(table, "CURRENT"), self._path(table, f"CURRENT-{name}")
        fs = pointer.getFileSystem(self._conf)
        out = fs.create(fresh, True)
        out.write(bytearray(name.encode()))
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(pointer.toUri(), self._conf)
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context.rename(fresh, pointer, options)

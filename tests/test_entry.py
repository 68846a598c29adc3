"""Every registered query of the core equals its SQL on the smallest tables."""

import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__
from reelgap.plans import catalogue

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, (float, Decimal)):
        return "nan" if math.isnan(value) else repr(round(float(value), 9) + 0.0)
    return repr(value)


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_equals_sql(spark, name):
    df = catalogue.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert name in catalogue.ORACLE
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    found = db.execute(catalogue.ORACLE[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    assert sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()) == got


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

"""Every registered query of the core against DuckDB, on the smallest tables."""

import datetime
import decimal
import glob
import math
import os

import duckdb
import pytest
from pyspark.errors import SparkRuntimeException

from eventpulse.plans import catalog

SF = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("set TimeZone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def one(x):
        if isinstance(x, (float, decimal.Decimal)):
            return "nan" if math.isnan(x) else repr(round(float(x), 9))
        return x.replace(tzinfo=None).isoformat() if isinstance(x, datetime.datetime) else str(x)

    return sorted(tuple(one(r[i]) for i in order) for r in rows)


#: The smallest tables have no busy repository on the held-out day, so there are no rates of it: they are compared on larger ones.
NO_RATES = "held_out_rates"


def test_rates_of_nothing_are_refused(spark):
    with pytest.raises(SparkRuntimeException, match="no busy_repo_days to divide by"):
        QUERIES[NO_RATES](spark, SF).collect()


def test_rates_as_duckdb(spark):
    con = duckdb.connect()
    con.sql("create view events as select * from '/root/testdata/sf0.01/events.parquet'")
    frame, relation = QUERIES[NO_RATES](spark, "/root/testdata/sf0.01"), con.sql(SQL[NO_RATES])
    assert plain(frame.collect(), frame.columns) == plain(relation.fetchall(), relation.columns)


@pytest.mark.parametrize("name", sorted(set(SQL) - {NO_RATES}))
def test_as_duckdb(spark, duck, name):
    frame, relation = QUERIES[name](spark, SF), duck.sql(SQL[name])
    assert sorted(frame.columns) == sorted(relation.columns)
    assert plain(frame.collect(), frame.columns) == plain(relation.fetchall(), relation.columns)


def test_fifo_against_a_plain_window(spark):
    from collections import OrderedDict

    rows = sorted(((r.seq, r.id) for r in catalog.Tables(spark, SF).lake.selectExpr("id", "unix_micros(cast(created_at as timestamp)) seq").collect()))
    seen, fresh = OrderedDict(), set()
    for seq, i in rows:
        if i not in seen:
            fresh.add((i, seq))
            if len(seen) >= 1000:
                seen.popitem(last=False)
            seen[i] = None
    assert {(r.id, r.seq) for r in QUERIES["stream_fifo_dedup"](spark, SF).collect()} == fresh


def test_every_query_but_one_has_sql():
    assert set(QUERIES) - set(SQL) == {"stream_fifo_dedup"}

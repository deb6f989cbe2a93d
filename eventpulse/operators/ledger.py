"""The ledger of archive hours: what is known of each hour of each day, at most one row an hour.

Rows: day, hour, status (``ingested``, ``missing`` or ``failed``), events, bytes, detail, recorded_at. The functions are pure; ``LedgerTable``
keeps the state as versioned Parquet with one writer.
"""

from __future__ import annotations

import threading
import uuid
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventpulse.functions.events import HOURS_A_DAY, hour_end
from eventpulse.sources import files

SCHEMA = "day date, hour smallint, status string, events bigint, bytes bigint, detail string, recorded_at timestamp"
INGESTED, MISSING, FAILED = "ingested", "missing", "failed"
STATUSES = (INGESTED, MISSING, FAILED)


def invalid(rows: DataFrame) -> DataFrame:
    """Rows that the ledger refuses: an hour out of range, an unknown status, negative numbers, or an ingested hour without a count."""
    negative = F.coalesce(F.least("events", "bytes") < 0, F.lit(False))
    domain = F.coalesce(F.col("hour").between(0, 23) & F.col("status").isin(*STATUSES), F.lit(False))
    uncounted = (F.col("status") == INGESTED) & F.col("events").isNull()
    return rows.where(F.col("day").isNull() | ~domain | negative | uncounted)


def upsert(ledger: DataFrame, records: DataFrame) -> DataFrame:
    """Later records replace earlier ones, but nothing other than an ingested record replaces an ingested one."""
    new = records.select(*ledger.columns, F.lit(1).alias("_new"))
    both = ledger.withColumn("_new", F.lit(0)).unionByName(new)
    first = F.row_number().over(Window.partitionBy("day", "hour").orderBy((F.col("status") == INGESTED).desc(), F.desc("_new"), F.col("recorded_at").desc_nulls_last(), "events"))
    return both.withColumn("_n", first).where("_n = 1").drop("_n", "_new")


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Each hour of each day from first to last; none if the range is reversed."""
    day = F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date")))
    days = spark.range(1).where(F.lit(first).cast("date") <= F.lit(last).cast("date")).select(day.alias("day"))
    return days.select("day", F.explode(F.sequence(F.lit(0), F.lit(HOURS_A_DAY - 1))).alias("hour"))


def pending_hours(spark: SparkSession, ledger: DataFrame, first: str, last: str, retry_failed: bool = False) -> DataFrame:
    """Hours without a record, or with one that isn't settled. Missing hours are settled; failed ones only if they aren't to be retried."""
    settled = [INGESTED, MISSING] if retry_failed else [INGESTED, MISSING, FAILED]
    known = ledger.select(F.col("day").alias("_day"), F.col("hour").alias("_hour"), "status")
    met = calendar(spark, first, last).join(known, (F.col("day") == F.col("_day")) & (F.col("hour") == F.col("_hour")), "left")
    return met.where(F.col("status").isNull() | ~F.col("status").isin(*settled)).select("day", F.col("hour").cast("int").alias("hour"))


def due_hours(pending: DataFrame, now: str) -> DataFrame:
    """Pending hours that are over at ``now`` (UTC)."""
    return pending.where(hour_end(F.col("day"), F.col("hour")) <= F.lit(now).cast("timestamp_ntz"))


def status_counts(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("status").agg(F.count("*").alias("hours"), F.coalesce(F.sum("events"), F.lit(0)).cast("bigint").alias("events"))


def ingested_hours(ledger: DataFrame) -> DataFrame:
    return ledger.where(F.col("status") == INGESTED).select("day", "hour", "events", "bytes")


def forget(ledger: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, forgotten): only ingested rows among the targets are forgotten."""
    keys = targets.select(F.col("day").alias("_day"), F.col("hour").alias("_hour")).distinct()
    on = (F.col("day") == F.col("_day")) & (F.col("hour") == F.col("_hour")) & (F.col("status") == INGESTED)
    return ledger.join(keys, on, "left_anti"), ledger.join(keys, on, "left_semi")


def jdbc_ledger(spark: SparkSession, url: str, table: str, first: str, last: str, parts: int = 8, **options: str) -> DataFrame:
    """A ledger held in a database, of the days from ``first`` to ``last``, read by ``parts`` tasks, each a range of days.

    The range and what is filtered afterwards is left to the database, which sends only the rows and columns asked for.
    """
    days = (date.fromisoformat(last) - date.fromisoformat(first)).days + 1
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, pushDownPredicate="true", **options)
    if days > 1:
        reader = reader.options(partitionColumn="day", lowerBound=first, upperBound=str(date.fromisoformat(last) + timedelta(days=1)), numPartitions=str(min(parts, days)))
    rows = reader.load()
    named = {c.lower(): F.col(c) for c in rows.columns}
    # Text stays uncast, so that filters on it can go to the database.
    rows = rows.select(*((named[name] if kind == "string" else named[name].cast(kind)).alias(name) for name, kind in (x.split() for x in SCHEMA.split(", "))))
    return rows.where(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


class LedgerTable:
    """Versions of the ledger under one folder. A write makes a new version and then names it; readers see the last named one."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path, self._lock = spark, path.rstrip("/"), threading.Lock()

    def read(self) -> DataFrame:
        name = files.read_text(self.spark, f"{self.path}/CURRENT")
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/{name}") if name else self.spark.createDataFrame([], SCHEMA)

    def _publish(self, rows: DataFrame) -> None:
        name = f"v-{uuid.uuid4().hex}"
        rows.coalesce(1).write.parquet(f"{self.path}/{name}")  # hours of the archive: a few thousand rows a year
        old = files.read_text(self.spark, f"{self.path}/CURRENT")
        files.write_text(self.spark, f"{self.path}/CURRENT", name)
        if old:
            files.delete(self.spark, f"{self.path}/{old}")

    def record(self, *rows: tuple) -> None:
        """Upsert (day, hour, status, events, bytes, detail, recorded_at) rows; refused rows raise ValueError."""
        new = self.spark.createDataFrame(list(rows), SCHEMA)
        if refused := invalid(new).take(1):
            raise ValueError(f"refused by the ledger: {refused[0].asDict()}")
        with self._lock:
            self._publish(upsert(self.read(), new))

    def forget(self, targets: list[tuple]) -> list[tuple]:
        """Forget ingested hours and return them as (day, hour, events, bytes)."""
        with self._lock:
            kept, gone = forget(self.read(), self.spark.createDataFrame(targets, "day date, hour smallint"))
            out = [(r.day, r.hour, r.events, r.bytes) for r in gone.orderBy("day", "hour").collect()]
            self._publish(kept)
        return out

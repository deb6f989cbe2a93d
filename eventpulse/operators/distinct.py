"""Distinct counts that merge: exact bitmaps of numbered values, kept by day, from which any period's counts are rolled up.

A dictionary numbers the values of each kind from 1 in the order in which they come, without gaps, so bitmaps stay as dense as values are many: 32,768 to a bitmap of 4 KB, whatever the ids look like.
A day's partials are its bitmaps by kind and bucket, and its counts by type and hour. Adding a day reads that day's rows and the dictionary; counts of any days are ``bitmap_or_agg`` over
their partials, exact and without a distinct over rows.

Layout under the store's path: ``dictionary/`` (kind, value, number), ``bitmaps/day=…`` (kind, bucket, bitmap), ``counts/day=…`` (type, hour, events, without_repo, first_at, last_at).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventpulse.functions.events import BREAKOUTS
from eventpulse.operators import ranking
from eventpulse.sources import files

DICTIONARY = "kind string, value string, number bigint"
BITMAPS = "kind string, bucket bigint, bitmap binary, day date"
COUNTS = "event_type string, hour bigint, events bigint, without_repo bigint, first_at timestamp_ntz, last_at timestamp_ntz, day date"
#: Kinds of values and the column of staged events that each is.
KINDS = {"repo": "repo_id", "actor": "actor_id", "repo_name": "repo_name", "login": "actor_login"}


class DistinctStore:
    """Partials of staged events under a path. One writer; a day that is added again is replaced."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, part: str, schema: str) -> DataFrame:
        found = files.exists(self.spark, f"{self.path}/{part}")
        return self.spark.read.schema(schema).parquet(f"{self.path}/{part}") if found else self.spark.createDataFrame([], schema)

    def dictionary(self) -> DataFrame:
        return self._read("dictionary", DICTIONARY)

    def bitmaps(self) -> DataFrame:
        return self._read("bitmaps", BITMAPS)

    def counts(self) -> DataFrame:
        return self._read("counts", COUNTS)

    def add(self, stg: DataFrame) -> None:
        """Add the days of staged events: new values are numbered first, then the days' partials are written over what they had.

        Numbers, once given, stay: a run that ends between the two steps is made good by the next one.
        """
        staging = files.shared_dir(self.spark)
        # Written once: what the events come from is worked out a single time, and each kind then reads its own column.
        own = stg.select("archive_day", "archive_hour", "event_type", "created_at", "repo_id", *(c for c in KINDS.values() if c != "repo_id"))
        own.write.parquet(f"{staging}/events")
        stg = self.spark.read.schema(own.schema).parquet(f"{staging}/events")
        each = [stg.select(F.col("archive_day").alias("day"), c).where(F.col(c).isNotNull()).distinct().select("day", F.lit(k).alias("kind"), F.col(c).cast("string").alias("value")) for k, c in KINDS.items()]
        reduce(DataFrame.union, each).write.parquet(f"{staging}/values")
        values = self.spark.read.schema("day date, kind string, value string").parquet(f"{staging}/values")
        known = self.dictionary()
        new = ranking.ranked(values.select("kind", "value").distinct().join(known, ["kind", "value"], "left_anti"), ["kind"], ["value"], "nth")
        last = {r.kind: r.n for r in known.groupBy("kind").agg(F.max("number").alias("n")).collect()}  # one row a kind
        start = F.coalesce(*(F.when(F.col("kind") == k, n) for k, n in last.items()), F.lit(0)) if last else F.lit(0)
        new.select("kind", "value", (start + F.col("nth")).cast("bigint").alias("number")).write.mode("append").parquet(f"{self.path}/dictionary")
        numbered = values.join(self.dictionary(), ["kind", "value"])
        maps = numbered.groupBy("day", "kind", F.bitmap_bucket_number("number").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"))
        self._replace(maps.select("kind", "bucket", "bitmap", "day"), "bitmaps")
        counts = stg.groupBy("event_type", F.col("archive_hour").alias("hour"), F.col("archive_day").alias("day")).agg(
            F.count("*").alias("events"), F.count_if(F.col("repo_id").isNull()).alias("without_repo"), F.min("created_at").alias("first_at"), F.max("created_at").alias("last_at"),
        )
        self._replace(counts.select("event_type", "hour", "events", "without_repo", "first_at", "last_at", "day"), "counts")
        files.delete(self.spark, staging)

    def _replace(self, rows: DataFrame, part: str) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{self.path}/{part}")

    def distinct(self, *by: str, bitmaps: DataFrame | None = None) -> DataFrame:
        """One row for each of ``by`` (columns of the bitmaps; none: one row), a count for each kind."""
        maps = self.bitmaps() if bitmaps is None else bitmaps
        merged = maps.groupBy(*by, "kind", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n"))
        return merged.groupBy(*by).agg(*(F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).cast("bigint").alias(k) for k in KINDS))

    def ecosystem_daily(self) -> DataFrame:
        """The daily mart, from partials alone."""
        typed = [F.coalesce(F.sum(F.when(F.col("event_type") == t, F.col("events"))), F.lit(0)).cast("bigint").alias(c) for c, t in BREAKOUTS.items()]
        daily = self.counts().groupBy("day").agg(
            F.sum("events").cast("bigint").alias("events"), *typed, F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("hour") + 1))).cast("bigint").alias("hours_present"),
            F.sum("without_repo").cast("bigint").alias("events_without_repo"), F.min("first_at").alias("first_event_at"), F.max("last_at").alias("last_event_at"),
        )
        ids = self.distinct("day").select(F.col("day").alias("_day"), F.col("repo").alias("repos"), F.col("actor").alias("actors"))
        met = daily.join(ids, F.col("day") == F.col("_day"), "left").fillna(0, ["repos", "actors"])
        return met.select("day", "events", "repos", "actors", *BREAKOUTS, "hours_present", "events_without_repo", "first_event_at", "last_event_at")

    def overview(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """Events, days, hours, names, logins and types of all days, or of those from ``first`` to ``last``."""
        within = F.lit(True) if first is None else F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        hours = self.counts().where(within).groupBy("day", "hour").agg(F.sum("events").alias("events"))
        total = hours.groupBy("day").agg(F.sum("events").alias("events"), F.count("*").alias("hours"))
        total = total.agg(F.coalesce(F.sum("events"), F.lit(0)).cast("bigint").alias("events"), F.count("*").alias("days"), F.coalesce(F.sum("hours"), F.lit(0)).cast("bigint").alias("hours"))
        types = self.counts().where(within).select("event_type").distinct().agg(F.count("event_type").alias("types"))
        names = self.distinct(bitmaps=self.bitmaps().where(within)).select(F.col("repo_name").alias("repos"), F.col("login").alias("actors"))
        return total.join(names).join(types).select("events", "days", "hours", "repos", "actors", "types")  # one row each

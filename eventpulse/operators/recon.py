"""Reconciliation: ledger against files, repairs, marts against the lake, gaps in history, and live against archive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def verify(claims: DataFrame, files: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Findings (day, hour, problem, claimed, actual) of claims (day, hour, events, bytes) against files (day, hour, bytes).

    The first failing check of a claim counts: ``absent``, ``size`` (where bytes are claimed), ``count`` (where ``counts`` by
    day and hour are given). A file that nothing claims is ``unrecorded``.
    """
    f = files.select(F.col("day").alias("f_day"), F.col("hour").alias("f_hour"), F.col("bytes").alias("f_bytes"))
    met = claims.join(f, (F.col("day") == F.col("f_day")) & (F.col("hour") == F.col("f_hour")), "full")
    if counts is None:
        met = met.withColumn("n", F.lit(None).cast("bigint"))
    else:
        c = counts.select(F.col("day").alias("c_day"), F.col("hour").alias("c_hour"), F.col("n"))
        met = met.join(c, (F.col("day") == F.col("c_day")) & (F.col("hour") == F.col("c_hour")), "left")
    wrong_count = F.lit(counts is not None) & (F.col("n").isNull() | (F.col("n") != F.col("events")))
    problem = (
        F.when(F.col("day").isNull(), "unrecorded").when(F.col("f_day").isNull(), "absent")
        .when(F.col("bytes").isNotNull() & (F.col("bytes") != F.col("f_bytes")), "size").when(wrong_count, "count")
    )
    claimed = F.when(problem == "size", F.col("bytes")).when(problem.isin("absent", "count"), F.col("events"))
    actual = F.when(problem.isin("size", "unrecorded"), F.col("f_bytes")).when(problem == "count", F.coalesce("n", F.lit(0)))
    rows = met.select(F.coalesce("day", "f_day").alias("day"), F.coalesce("hour", "f_hour").cast("int").alias("hour"), problem.alias("problem"), claimed.alias("claimed"), actual.alias("actual"))
    return rows.where("problem is not null")


def unbacked(findings: DataFrame) -> DataFrame:
    """Claims proven false; a surplus file is none."""
    return findings.where("problem <> 'unrecorded'")


def reconcile_repairs(claims: DataFrame, refetched: DataFrame) -> DataFrame:
    """Verdict on each refetched hour (day, hour, status, events): what it claimed against what came back. An hour that was never claimed raises."""
    c = claims.select(F.col("day").alias("c_day"), F.col("hour").alias("c_hour"), F.col("events").alias("claimed"))
    met = refetched.join(c, (F.col("day") == F.col("c_day")) & (F.col("hour") == F.col("c_hour")), "left")
    claimed = F.when(F.col("c_day").isNull(), F.raise_error(F.lit("a refetched hour was never claimed")).cast("bigint")).otherwise(F.col("claimed"))
    verdict = F.when(F.col("status") != "ingested", "NOT RECOVERED").when(F.col("events") == F.col("claimed"), "match").otherwise("DIFFERS")
    return met.select("day", F.col("hour").cast("int").alias("hour"), claimed.alias("claimed"), F.col("events").alias("actual"), verdict.alias("verdict"))


def marts_freshness(lake_hours: DataFrame, mart_days: DataFrame) -> DataFrame:
    """Drift of each day: (day, lake_hours, mart_hours, kind, hours_behind) from (day, hours) and (day, hours_present)."""
    m = mart_days.select(F.col("day").alias("m_day"), F.col("hours_present").alias("mart_hours"))
    met = lake_hours.withColumnRenamed("hours", "lake_hours").join(m, F.col("day") == F.col("m_day"), "full")
    held, built = F.coalesce("lake_hours", F.lit(0)), F.coalesce("mart_hours", F.lit(0))
    kind = F.when(F.col("m_day").isNull(), "unbuilt").when(built < held, "behind").when(built > held, "surplus").otherwise("current")
    behind = F.when(kind.isin("unbuilt", "behind"), held - built).otherwise(0)
    return met.select(F.coalesce("day", "m_day").alias("day"), held.cast("bigint").alias("lake_hours"), F.col("mart_hours").cast("bigint").alias("mart_hours"), kind.alias("kind"), behind.cast("bigint").alias("hours_behind"))


def missing_days(history: DataFrame) -> DataFrame:
    """Days between the first and the last of the history that it doesn't have."""
    span = history.agg(F.min("day").alias("a"), F.max("day").alias("b")).where("a is not null")
    every = span.select(F.explode(F.sequence("a", "b")).alias("day"))
    return every.join(history.select("day").distinct(), "day", "left_anti")


def history_status(history: DataFrame, as_of: str, grace: int = 1) -> DataFrame:
    """One row on a history of (day, hours_present, events): empty, stalled, holed, partial days and the latest expected day."""
    expected = F.date_sub(F.lit(as_of).cast("date"), 1 + grace)
    seen = history.agg(F.count("*").alias("days"), F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count_if(F.col("hours_present") < 24).alias("partial_days"))
    holes = missing_days(history).agg(F.count("*").alias("missing_days"))
    stalled = (F.col("days") == 0) | (F.col("last_day") < expected)
    return seen.crossJoin(holes).select(  # one row each
        "days", "first_day", "last_day", expected.alias("expected_latest"), "partial_days", "missing_days", (F.col("days") == 0).alias("empty"), stalled.alias("stalled"),
        (F.col("missing_days") > 0).alias("holed"), (~stalled & (F.col("missing_days") == 0)).alias("healthy"), F.greatest(F.datediff(expected, F.col("last_day")), F.lit(0)).cast("bigint").alias("stale_by_days"),
    )


def history_volume(history: DataFrame) -> DataFrame:
    """Least, upper median and most events of a day, and how many days are under half the median. One value a day is gathered."""
    ordered = history.agg(F.sort_array(F.collect_list("events")).alias("e")).where(F.size("e") > 0)
    middle = F.element_at("e", (F.floor(F.size("e") / 2) + 1).cast("int"))
    return ordered.select(
        F.element_at("e", 1).alias("least"), middle.alias("median"), F.element_at("e", -1).alias("most"),
        F.size(F.filter("e", lambda x: 2 * x < F.element_at("e", (F.floor(F.size("e") / 2) + 1).cast("int")))).cast("bigint").alias("thin_days"),
    )


def thin_days(history: DataFrame) -> DataFrame:
    """Days with less than half the upper median of events."""
    median = history_volume(history).select(F.col("median"))
    return history.join(median, 2 * F.col("events") < F.col("median")).select("day", "events", "median")


def capture_overlap(live: DataFrame, archive: DataFrame) -> DataFrame:
    """Distinct ids of both and of either, and the share of the archive that was captured live.

    0 with an empty archive; null if there are live ids and none of them is in the archive, since then the two don't cover the same time.
    """
    a = live.select("id", F.lit(1).alias("l"), F.lit(0).alias("r")).union(archive.select("id", F.lit(0).alias("l"), F.lit(1).alias("r")))
    ids = a.where("id is not null").groupBy("id").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    n = ids.agg(F.count_if(F.col("l") == 1).alias("live_ids"), F.count_if(F.col("r") == 1).alias("archive_ids"), F.count_if((F.col("l") == 1) & (F.col("r") == 1)).alias("matched"))
    rate = F.when(F.col("archive_ids") == 0, 0.0).when((F.col("matched") == 0) & (F.col("live_ids") > 0), None).otherwise(F.col("matched").cast("double") / F.col("archive_ids"))
    return n.withColumn("capture_rate", rate)

"""Dashboard queries by name, and the guard that keeps account-level rows out of what is published."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date
from functools import wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PRIVATE = re.compile(r"\b(?:restricted\s*\.|public\s*\.\s*events\b|actor_daily\b|actor_login\b)", re.I)


class NotPublishable(ValueError):
    """A published query touches restricted data."""


def guard(sql: str) -> str:
    """The query, if it names neither the restricted database nor the raw event store."""
    plain = re.sub(r"--[^\n]*|/\*.*?\*/", " ", sql, flags=re.S).replace("`", "").replace('"', "")
    if found := _PRIVATE.search(plain):
        raise NotPublishable(f"a published query may not read {found.group(0)!r}")
    return sql


#: Columns that tell accounts apart: no panel returns them.
PRIVATE_COLUMNS = {"actor_id", "actor_login"}


def relations(frame: DataFrame) -> list[str]:
    """The catalogue's tables that the analyzed plan of a frame reads, as database.table."""
    leaves, found = frame._jdf.queryExecution().analyzed().collectLeaves(), []
    for k in range(leaves.size()):
        text = leaves.apply(k).toString()
        if m := re.match(r"(?:Relation|HiveTableRelation) \[?`?(?:\w+`?\.`?)?(\w+)`?\.`?(\w+)`?\W", text):
            found.append(f"{m[1]}.{m[2]}")
    return found


def guarded(frame: DataFrame) -> DataFrame:
    """The frame, if its plan reads no restricted table, under whatever name, and no column of it tells accounts apart."""
    if bad := [r for r in relations(frame) if r.split(".")[0].lower() == "restricted"]:
        raise NotPublishable(f"a published panel may not read {bad[0]}")
    if bad := PRIVATE_COLUMNS & {c.lower() for c in frame.columns}:
        raise NotPublishable(f"a published panel may not have {sorted(bad)[0]}")
    return frame


def panel(run: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A panel whose frame passes ``guarded`` before anything runs."""

    @wraps(run)
    def checked(*args, **more) -> DataFrame:
        return guarded(run(*args, **more))

    return checked


def _round(c: Column) -> Column:
    return F.round(c, 2)


def publish(sql: str, **frames: DataFrame) -> DataFrame:
    """Run a published query over the frames it names in braces; restricted names are refused before anything runs."""
    return guarded(next(iter(frames.values())).sparkSession.sql(guard(sql), **frames))


def _of_latest(per_day: DataFrame, *values: str) -> list[Column]:
    """Aggregates that pick the latest day's values of a frame with one row a day."""
    return [F.max_by(v, "day").alias(v) for v in values]


def _latest(trending: DataFrame) -> DataFrame:
    """The latest day's rows: the ranking is a written table, of which the day is looked up and then read."""
    return trending.join(trending.agg(F.max("day").alias("_latest")), F.col("day") == F.col("_latest"))


def hours_ingested(ledger: DataFrame) -> DataFrame:
    return publish("select count(*) as value from {ledger} where status = 'ingested'", ledger=ledger)


def hours_outstanding(ledger: DataFrame) -> DataFrame:
    return publish("select count(*) as value from {ledger} where status in ('missing', 'failed')", ledger=ledger)


@panel
def freshness_hours(ledger: DataFrame, now: str) -> DataFrame:
    """Hours from the start of the newest ingested hour to ``now``."""
    start = F.unix_timestamp(F.col("day").cast("timestamp")) + F.col("hour") * 3600
    return ledger.where("status = 'ingested'").agg(((F.unix_timestamp(F.lit(now).cast("timestamp")) - F.max(start)) / 3600.0).cast("double").alias("value"))


def events_recorded(ledger: DataFrame) -> DataFrame:
    return publish("select cast(coalesce(sum(events), 0) as bigint) as value from {ledger} where status = 'ingested'", ledger=ledger)


@panel
def hours_not_built(ledger: DataFrame, ecosystem: DataFrame) -> DataFrame:
    held = ledger.where("status = 'ingested' and events > 0").groupBy("day").agg(F.count("*").alias("hours"))
    built = ecosystem.select(F.col("day").alias("_day"), F.coalesce("hours_present", F.lit(0)).alias("built"))
    met = held.join(built, F.col("day") == F.col("_day"), "left")
    behind = F.col("hours") - F.coalesce("built", F.lit(0))
    return met.where(behind > 0).agg(F.coalesce(F.sum(behind), F.lit(0)).cast("bigint").alias("hours_not_built"))


def coverage(ecosystem: DataFrame, first: str, last: str) -> DataFrame:
    return publish(f"select day, hours_present as hours_held from {{ecosystem}} where day between date '{date.fromisoformat(first)}' and date '{date.fromisoformat(last)}' order by day", ecosystem=ecosystem)


def daily_totals(ecosystem: DataFrame, first: str, last: str) -> DataFrame:
    return publish(f"select day, events, repos as repositories, actors as accounts from {{ecosystem}} where day between date '{date.fromisoformat(first)}' and date '{date.fromisoformat(last)}' order by day", ecosystem=ecosystem)


def recent_hours(ledger: DataFrame, top: int = 50) -> DataFrame:
    return publish(f"select * from {{ledger}} order by day desc, hour desc limit {int(top)}", ledger=ledger)


def days_comparable(trending: DataFrame) -> DataFrame:
    return publish("select count(distinct day) as days from {trending}", trending=trending)


@panel
def ranked_latest(trending: DataFrame) -> DataFrame:
    days = trending.groupBy("day").agg(F.count("*").alias("repositories"))
    return days.agg(*_of_latest(days, "repositories")).select(F.coalesce("repositories", F.lit(0).cast("bigint")).alias("repositories"))


@panel
def largest_gain(trending: DataFrame) -> DataFrame:
    days = trending.groupBy("day").agg(F.max("actors_change").alias("accounts"))
    return days.agg(*_of_latest(days, "accounts")).select(F.coalesce("accounts", F.lit(0)).cast("bigint").alias("accounts"))


@panel
def first_appearances(trending: DataFrame) -> DataFrame:
    days = trending.groupBy("day").agg(F.count_if("absent_prior_day").alias("repositories"))
    return days.agg(*_of_latest(days, "repositories")).select(F.coalesce("repositories", F.lit(0).cast("bigint")).alias("repositories"))


@panel
def gainers(trending: DataFrame, top: int = 25) -> DataFrame:
    """The rank within the day is by change, so the first ranks are the greatest gains."""
    rows = _latest(trending).where((F.col("rank_in_day") <= top) & (F.col("actors_change") > 0)).orderBy("rank_in_day")
    return rows.select("rank_in_day", "repo_name", "actors_prior", "actors", "actors_change", _round(F.col("actors_change_ratio")).alias("proportional"))


@panel
def losers(trending: DataFrame, top: int = 25) -> DataFrame:
    """Ties after change and prior accounts go by repository id."""
    order = ["actors_change", F.desc("actors_prior"), "repo_id"]
    rows = _latest(trending).where("actors_change < 0").orderBy(*order).limit(top)  # each task keeps so many
    return rows.orderBy(*order).select("repo_name", "actors_prior", "actors", "actors_change", _round(F.col("actors_change_ratio")).alias("proportional"))


def movement_by_day(trending: DataFrame) -> DataFrame:
    return publish("select day, count_if(actors_change > 0) as gaining, count_if(actors_change < 0) as losing, count_if(actors_change = 0) as unchanged from {trending} group by day", trending=trending)

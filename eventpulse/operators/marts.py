"""Daily marts at ecosystem, repository and (restricted) account grain, and the day-over-day ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventpulse.functions.events import AGGREGATE_FLOOR, BREAKOUTS, HOURS_A_DAY, TRENDING_FLOOR, breakouts, latest
from eventpulse.operators import ranking


def _span() -> list:
    return [F.min("created_at").alias("first_event_at"), F.max("created_at").alias("last_event_at")]


def ecosystem_daily(stg: DataFrame) -> DataFrame:
    """One row a day over all events. The hours present are a set of at most 24, combined map-side."""
    return stg.groupBy(F.col("archive_day").alias("day")).agg(
        F.count("*").alias("events"), F.countDistinct("repo_id").alias("repos"), F.countDistinct("actor_id").alias("actors"), *breakouts("event_type"),
        F.size(F.collect_set("archive_hour")).cast("bigint").alias("hours_present"), F.count_if(F.col("repo_id").isNull()).alias("events_without_repo"), *_span(),
    )


def repo_daily(stg: DataFrame) -> DataFrame:
    """One row a day and repository; events without one are left out, and the latest name counts."""
    return stg.where("repo_id is not null").groupBy(F.col("archive_day").alias("day"), "repo_id").agg(
        latest(F.col("repo_name"), F.col("created_at"), F.col("event_id")).alias("repo_name"),
        F.count("*").alias("events"), F.countDistinct("actor_id").alias("actors"), *breakouts("event_type"), *_span(),
    )


def actor_daily(stg: DataFrame) -> DataFrame:
    """One row a day and account. Restricted: never to be published."""
    return stg.groupBy(F.col("archive_day").alias("day"), "actor_id").agg(
        latest(F.col("actor_login"), F.col("created_at"), F.col("event_id")).alias("actor_login"),
        F.count("*").alias("events"), F.countDistinct("repo_id").alias("repos"), *breakouts("event_type"), *_span(),
    )


def comparable_days(ecosystem: DataFrame, hours: int = HOURS_A_DAY) -> DataFrame:
    return ecosystem.where(F.col("hours_present") == hours).select("day")


def adjacent_day_pairs(ecosystem: DataFrame, hours: int = HOURS_A_DAY) -> DataFrame:
    """Complete days whose calendar predecessor is complete too: a join on the date, since a lag would skip gaps."""
    days = comparable_days(ecosystem, hours)
    previous = days.select(F.date_add("day", 1).alias("_next"), F.col("day").alias("prior_day"))
    return days.join(previous, F.col("day") == F.col("_next")).select("day", "prior_day")


def repo_trending(repos: DataFrame, ecosystem: DataFrame, floor: int = TRENDING_FLOOR, hours: int = HOURS_A_DAY, days: Column | None = None) -> DataFrame:
    """Repositories active today against the complete day before, ranked by change in participants; of all days, or those for which ``days`` holds.

    The pairs of days are left to the optimizer to broadcast by their measured size. The floor applies before ranking. A day's ranks
    are given by many tasks (``ranking``), so that a day of any size has no window to itself.
    """
    pairs = adjacent_day_pairs(ecosystem, hours)
    pairs = pairs if days is None else pairs.where(days)
    prior = repos.select(F.col("repo_id").alias("_repo"), F.col("day").alias("_day"), F.col("actors").alias("_actors"), F.col("events").alias("_events"))
    now = repos.join(pairs, "day")
    rows = now.join(prior, (F.col("repo_id") == F.col("_repo")) & (F.col("prior_day") == F.col("_day")), "left")
    before = F.coalesce("_actors", F.lit(0))
    rows = rows.select(
        "day", "repo_id", "repo_name", "actors", before.alias("actors_prior"), (F.col("actors") - before).alias("actors_change"),
        F.when(before != 0, (F.col("actors") - before).cast("double") / before).alias("actors_change_ratio"),
        "events", F.coalesce("_events", F.lit(0)).alias("events_prior"), F.col("_repo").isNull().alias("absent_prior_day"),
    ).where(F.greatest("actors", "actors_prior") >= floor)
    return ranking.ranked(rows, ["day"], [F.desc("actors_change"), F.desc("actors"), "repo_id"], "rank_in_day")


def ecosystem_aggregate(lake: DataFrame) -> DataFrame:
    """The permanent ecosystem file of each day: duplicates are removed within the day."""
    from eventpulse.operators.staging import stg_events

    return ecosystem_daily(stg_events(lake, "day", payload=False))


def repo_aggregate(lake: DataFrame, floor: int = AGGREGATE_FLOOR) -> DataFrame:
    """The permanent repository file of each day: repositories at or over the floor, which is stamped on every row."""
    from eventpulse.operators.staging import stg_events

    return repo_daily(stg_events(lake, "day", payload=False)).where(F.col("events") >= floor).withColumn("min_events", F.lit(floor).cast("int"))


MART_COLUMNS = {
    "ecosystem_daily": ["day", "events", "repos", "actors", *BREAKOUTS, "hours_present", "events_without_repo", "first_event_at", "last_event_at"],
    "repo_daily": ["day", "repo_id", "repo_name", "events", "actors", *BREAKOUTS, "first_event_at", "last_event_at"],
    "actor_daily": ["day", "actor_id", "actor_login", "events", "repos", *BREAKOUTS, "first_event_at", "last_event_at"],
    "repo_trending": ["day", "repo_id", "repo_name", "actors", "actors_prior", "actors_change", "actors_change_ratio", "events", "events_prior", "absent_prior_day", "rank_in_day"],
}

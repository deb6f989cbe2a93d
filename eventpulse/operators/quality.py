"""Data assertions. Each returns the offending rows: none where the data is sound."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventpulse.functions.events import BREAKOUTS, HOURS_A_DAY, KNOWN_TYPES, TRENDING_FLOOR


def _differs(a, b):
    return ~F.col(a).eqNullSafe(b if not isinstance(b, str) else F.col(b))


def typed_events():
    total = F.lit(0).cast("bigint")
    for c in BREAKOUTS:
        total = total + F.col(c)
    return total


def duplicates(table: DataFrame, *keys: str) -> DataFrame:
    """Keys of more than one row."""
    return table.groupBy(*keys).agg(F.count("*").alias("rows_at_this_key")).where("rows_at_this_key > 1")


def nulls(table: DataFrame, *columns: str) -> DataFrame:
    """(column, nulls, severity): a count over 100 is an error, any other a warning, none ``ok``."""
    counts = table.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    rows = counts.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns))).alias("x")).select("x.*")
    return rows.withColumn("severity", F.when(F.col("nulls") > 100, "error").when(F.col("nulls") > 0, "warn").otherwise("ok"))


def unknown_types(stg: DataFrame) -> DataFrame:
    """Event types that the feed isn't known to publish, with their counts: a warning."""
    return stg.where(~F.col("event_type").isin(*KNOWN_TYPES)).groupBy("event_type").agg(F.count("*").alias("n"))


def repo_grain(repos: DataFrame) -> DataFrame:
    return duplicates(repos, "day", "repo_id")


def actor_grain(actors: DataFrame) -> DataFrame:
    return duplicates(actors, "day", "actor_id")


def ecosystem_sane(ecosystem: DataFrame) -> DataFrame:
    e = F.col("events")
    bad = (F.col("actors") > e) | (F.col("repos") > e) | (typed_events() > e) | (F.col("events_without_repo") > e) | ~F.col("hours_present").between(1, HOURS_A_DAY) | (e <= 0)
    return ecosystem.where(bad).select("day", "events", "repos", "actors", "hours_present", "events_without_repo")


def repo_counts(repos: DataFrame) -> DataFrame:
    bad = (F.col("actors") > F.col("events")) | (typed_events() > F.col("events")) | (F.col("events") <= 0)
    return repos.where(bad).select("day", "repo_id", "events", "actors", typed_events().alias("typed_events"))


def marts_reconcile(ecosystem: DataFrame, repos: DataFrame, actors: DataFrame) -> DataFrame:
    """Days on which the three marts don't add up. A day that only the two finer marts have yields a row for each."""
    r = repos.groupBy(F.col("day").alias("r_day")).agg(F.sum("events").alias("repo_events"), F.count("*").alias("repo_rows"))
    a = actors.groupBy(F.col("day").alias("a_day")).agg(F.count("*").alias("actor_rows"))
    all_of = ecosystem.join(r, F.col("r_day") == F.col("day"), "full").join(a, F.col("a_day") == F.col("day"), "full")
    off = _differs("repo_events", F.col("events") - F.col("events_without_repo")) | _differs("repos", "repo_rows") | _differs("actors", "actor_rows")
    bad = off | F.col("day").isNull() | F.col("r_day").isNull() | F.col("a_day").isNull()
    return all_of.where(bad).select("day", F.col("events").alias("ecosystem_events"), "events_without_repo", "repo_events", F.col("repos").alias("ecosystem_repos"), "repo_rows", F.col("actors").alias("ecosystem_actors"), "actor_rows")


def partition_matches_time(stg: DataFrame) -> DataFrame:
    """Events whose partition is not the UTC date and hour of their time."""
    bad = (F.col("archive_day") != F.to_date("created_at")) | (F.col("archive_hour") != F.hour("created_at"))
    return stg.where(bad).select("archive_day", "archive_hour", "event_id", "created_at")


def trending_adjacent(trending: DataFrame, ecosystem: DataFrame) -> DataFrame:
    """Ranked days that, or whose calendar predecessor, aren't complete."""
    full = ecosystem.where(F.col("hours_present") == HOURS_A_DAY).select("day")
    ranked = trending.select("day").distinct().select("day", F.date_sub("day", 1).alias("expected_prior_day"))
    this, prior = full.select(F.col("day").alias("_this")), full.select(F.col("day").alias("_prior"))
    met = ranked.join(this, F.col("day") == F.col("_this"), "left").join(prior, F.col("expected_prior_day") == F.col("_prior"), "left")
    return met.where("_this is null or _prior is null").select("day", "expected_prior_day", F.col("_this").isNull().alias("this_day_not_full"), F.col("_prior").isNull().alias("prior_day_not_full"))


def trending_grain(trending: DataFrame) -> DataFrame:
    """Repeated keys, and days whose ranks don't run without repetition from 1."""
    keys = duplicates(trending, "day", "repo_id").withColumnRenamed("rows_at_this_key", "rows_for_key")
    ranks = trending.groupBy("day").agg(F.count("*").alias("rows_in_day"), F.countDistinct("rank_in_day").alias("distinct_ranks"), F.min("rank_in_day").alias("_low"))
    off = ranks.where("rows_in_day <> distinct_ranks or _low <> 1").drop("_low")
    return keys.unionByName(off, allowMissingColumns=True).select("day", "repo_id", "rows_for_key", "rows_in_day", "distinct_ranks")


def trending_consistent(trending: DataFrame, floor: int = TRENDING_FLOOR) -> DataFrame:
    prior, ratio = F.col("actors_prior"), F.col("actors_change_ratio")
    bad = (
        _differs("actors_change", F.col("actors") - prior) | (F.col("actors") < 1) | (prior < 0) | (F.greatest("actors", "actors_prior") < floor) | (F.col("actors") > F.col("events"))
        | (prior > F.col("events_prior")) | (F.col("absent_prior_day") != (prior == 0)) | ((prior == 0) & ratio.isNotNull()) | ((prior > 0) & ratio.isNull())
    )
    return trending.where(bad).select("day", "repo_id", "actors", "actors_prior", "actors_change", "actors_change_ratio", "absent_prior_day")


@dataclass(frozen=True)
class Check:
    """A named assertion; ``warn`` reports without failing."""

    name: str
    rows: Callable[[], DataFrame]
    warn: bool = False


class AssertionFailed(RuntimeError):
    """An assertion found offending rows; what depends on them must not be built."""


def enforce(checks: list[Check]) -> list[tuple[str, str]]:
    """Run checks in order; (name, ``ok`` or ``warn``) of each. The first that fails raises, with a few of its rows."""
    told = []
    for check in checks:
        found = check.rows().take(5)  # a look at the offenders for the message
        if found and not check.warn:
            raise AssertionFailed(f"{check.name}: " + "; ".join(str(r.asDict()) for r in found))
        told.append((check.name, "warn" if found else "ok"))
    return told

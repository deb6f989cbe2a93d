"""Marts kept up to the lake day by day: only days whose files changed are staged and built again.

A day's fingerprint is a digest of its files' hours, sizes and times of writing; it is stored with the marts after they stand, so a pass that ends early is done over.
Copies of an id are removed within a day as the day is staged, and between days by a table of losers: the (day, id) of every row whose earlier copy is of another day. What they come to is
kept by day as a count and a digest, so a day that didn't change but lost or won a row is built again too. The ranking compares a day with the one before, so it is rebuilt for a changed day and the day after.

Under the base folder: ``staged/``, one folder for each mart, all by ``day=…``, and ``_state/``. What is built is written beside, checked, and then put over the published days only (dynamic partition overwrite).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventpulse.functions.events import TRENDING_FLOOR
from eventpulse.operators import marts, quality, staging
from eventpulse.operators.quality import Check
from eventpulse.sources import files, lake

STAGED = "event_id string, event_type string, actor_id bigint, actor_login string, repo_id bigint, repo_name string, org_login string, is_public boolean, created_at timestamp_ntz, archive_hour bigint, archive_day date"
_COUNTS = "events bigint, {}, pushes bigint, stars bigint, forks bigint, issues bigint, pull_requests bigint, releases bigint, {}first_event_at timestamp_ntz, last_event_at timestamp_ntz, day date"
SCHEMAS = {
    "ecosystem_daily": _COUNTS.format("repos bigint, actors bigint", "hours_present bigint, events_without_repo bigint, "),
    "repo_daily": "repo_id bigint, repo_name string, " + _COUNTS.format("actors bigint", ""),
    "actor_daily": "actor_id bigint, actor_login string, " + _COUNTS.format("repos bigint", ""),
    "repo_trending": "repo_id bigint, repo_name string, actors bigint, actors_prior bigint, actors_change bigint, actors_change_ratio double, events bigint, events_prior bigint, absent_prior_day boolean, rank_in_day bigint, day date",
}
_STATE = "day date, fingerprint string, losers bigint, losers_digest bigint"


@dataclass(frozen=True)
class Pass:
    """Days that a pass built again, by mart, and those that went."""

    changed: list[str]
    rebuilt: list[str]
    ranked: list[str]
    gone: list[str]


def fingerprints(spark: SparkSession, root: str) -> dict[str, str]:
    """A digest for each day of the lake."""
    told: dict[str, list[str]] = {}
    for day, hour, path, size in lake.lake_files(spark, root):
        told.setdefault(day, []).append(f"{hour}:{size}:{files.modified(spark, path)}")
    return {day: hashlib.md5(";".join(parts).encode()).hexdigest() for day, parts in told.items()}


def read(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A mart as it is published, or the staged events."""
    schema, path = SCHEMAS.get(name, STAGED), f"{base.rstrip('/')}/{name}"
    rows = spark.read.schema(schema).parquet(path) if files.exists(spark, path) else spark.createDataFrame([], schema)
    return rows.select("day", *(c for c in rows.columns if c != "day")) if name in SCHEMAS else rows


def _within(column: str, days: Iterable[str]):
    return F.col(column).isin(*(F.lit(d).cast("date") for d in sorted(days))) if days else F.lit(False)


def _put(rows: DataFrame, path: str, by: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def _losers(staged: DataFrame) -> DataFrame:
    """(event_id, archive_day) of rows that have an earlier copy on another day; ids are told apart within a day already."""
    words = staging.repeated(staged, ["event_id"])
    some = staging.among(staged.select("event_id", "archive_day", "created_at"), ["event_id"], words)
    order = F.struct(F.col("created_at").isNull().alias("undated"), "created_at", "archive_day")
    best = some.groupBy("event_id").agg(F.min_by("archive_day", order).alias("_best"), F.count("*").alias("_n")).where("_n > 1")
    return some.join(best, "event_id").where("archive_day <> _best").select("event_id", "archive_day")


def converge(spark: SparkSession, root: str, base: str, floor: int = TRENDING_FLOOR) -> Pass:
    """Bring the marts up to the lake; what was done. Raises where a check fails, with what is published left as it was."""
    base = base.rstrip("/")
    state_path = f"{base}/_state"
    name = files.read_text(spark, f"{state_path}/CURRENT")
    was = {str(r.day): r for r in spark.read.schema(_STATE).parquet(f"{state_path}/{name}").collect()} if name else {}  # one row a day
    now = fingerprints(spark, root)
    changed = {d for d, f in now.items() if d not in was or was[d].fingerprint != f}
    gone = set(was) - set(now)
    if not changed and not gone:
        return Pass([], [], [], [])

    if changed:
        rows = lake.read_lake(spark, root).where(_within("dt", changed)).withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
        own = staging.stg_events(rows, "day", payload=False)
        _put(own.select(*(c.split()[0] for c in STAGED.split(", "))), f"{base}/staged", "archive_day")
    for day in gone:
        files.delete(spark, f"{base}/staged/archive_day={day}")
    staged = read(spark, base, "staged")

    beside = files.shared_dir(spark)
    _losers(staged).write.parquet(f"{beside}/losers")
    losers = spark.read.schema("event_id string, archive_day date").parquet(f"{beside}/losers")
    tally = {str(r.archive_day): (r.n, r.digest) for r in losers.groupBy("archive_day").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("event_id")).alias("digest")).collect()}
    moved = {d for d in now if d in was and (was[d].losers, was[d].losers_digest) != tally.get(d, (0, 0))}
    rebuild = changed | moved
    stg = staged.where(_within("archive_day", rebuild)).join(losers, ["event_id", "archive_day"], "left_anti")

    def built(name: str, rows: DataFrame, days: set[str], checks) -> DataFrame:
        """Written beside and checked."""
        rows.write.parquet(f"{beside}/{name}")
        out = spark.read.schema(rows.schema).parquet(f"{beside}/{name}")
        quality.enforce(checks(out))
        return out

    quality.enforce([
        Check("stg_events not null", lambda: stg.where("event_id is null or event_type is null or created_at is null").select("event_id")),
        Check("partition matches time", lambda: quality.partition_matches_time(stg)),
    ])
    fresh = {
        "ecosystem_daily": built("ecosystem_daily", marts.ecosystem_daily(stg), rebuild, lambda t: [Check("ecosystem_daily sane", lambda: quality.ecosystem_sane(t)), Check("ecosystem_daily unique", lambda: quality.duplicates(t, "day"))]),
        "repo_daily": built("repo_daily", marts.repo_daily(stg), rebuild, lambda t: [Check("repo_daily grain", lambda: quality.repo_grain(t)), Check("repo_daily counts", lambda: quality.repo_counts(t))]),
        "actor_daily": built("actor_daily", marts.actor_daily(stg), rebuild, lambda t: [Check("actor_daily grain", lambda: quality.actor_grain(t))]),
    }
    quality.enforce([Check("marts reconcile", lambda: quality.marts_reconcile(fresh["ecosystem_daily"], fresh["repo_daily"], fresh["actor_daily"]))])
    for mart, rows in fresh.items():
        _publish(spark, base, mart, rows, rebuild | gone)

    touched = rebuild | gone
    ranked = touched | {str(date.fromisoformat(d) + timedelta(days=1)) for d in touched}
    around = ranked | {str(date.fromisoformat(d) - timedelta(days=1)) for d in ranked}
    eco, repos = read(spark, base, "ecosystem_daily"), read(spark, base, "repo_daily").where(_within("day", around))
    trending = marts.repo_trending(repos, eco, floor, days=_within("day", ranked))
    rows = built("repo_trending", trending, ranked, lambda t: [Check("repo_trending grain", lambda: quality.trending_grain(t)), Check("repo_trending consistent", lambda: quality.trending_consistent(t, floor)), Check("repo_trending adjacent", lambda: quality.trending_adjacent(t, eco))])
    _publish(spark, base, "repo_trending", rows, ranked)

    state = [(date.fromisoformat(d), f, *tally.get(d, (0, 0))) for d, f in sorted(now.items())]
    version = f"v-{hashlib.md5(repr(state).encode()).hexdigest()}"
    spark.createDataFrame(state, _STATE).coalesce(1).write.mode("overwrite").parquet(f"{state_path}/{version}")  # one row a day
    files.write_text(spark, f"{state_path}/CURRENT", version)
    files.delete(spark, beside)
    return Pass(sorted(changed), sorted(rebuild), sorted(ranked), sorted(gone))


def _publish(spark: SparkSession, base: str, mart: str, rows: DataFrame, days: set[str]) -> None:
    """Put rows over the days that they have; days without rows go."""
    columns = [c.split()[0] for c in SCHEMAS[mart].split(", ")]
    _put(rows.select(*columns), f"{base}/{mart}", "day")
    have = {str(r.day) for r in rows.select("day").distinct().collect()}
    for day in days - have:
        files.delete(spark, f"{base}/{mart}/day={day}")

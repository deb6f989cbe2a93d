"""Building the marts: models and assertions as one unit, in order; a failing assertion stops what comes after it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventpulse.functions.events import TRENDING_FLOOR
from eventpulse.operators import marts, quality, staging
from eventpulse.operators.quality import Check
from eventpulse.sources import files

PUBLISHED, RESTRICTED = "marts", "restricted"
#: Marts by repository are written in so many buckets of repo_id, sorted within each: joins on it between days need no shuffle.
BUCKETS = 32


class ColumnsDiffer(ValueError):
    """A mart has other columns than those that it may have."""


def build(spark: SparkSession, lake: DataFrame, floor: int = TRENDING_FLOOR) -> list[tuple[str, str]]:
    """Stage, assert, then build, assert and publish each mart; what each check came to.

    A mart is written beside, checked, and only then takes the published table's place, so that readers never meet a mart that failed.
    The staged events feed three marts and are written to the shared folder for the time of the build.
    """
    for name in (PUBLISHED, RESTRICTED):
        spark.sql(f"create database if not exists {name}")
    path = files.shared_dir(spark)
    own = staging.stg_events(lake, payload=False)
    own.write.parquet(path)
    stg = spark.read.schema(own.schema).parquet(path)
    told: list[tuple[str, str]] = []
    try:
        told += quality.enforce(
            [
                Check("stg_events unique", lambda: quality.duplicates(stg, "event_id")),
                Check("stg_events not null", lambda: stg.where("event_id is null or event_type is null or created_at is null").select("event_id")),
                Check("stg_events repository", lambda: quality.nulls(stg, "repo_id").where("severity = 'error'")),
                Check("stg_events types", lambda: quality.unknown_types(stg), warn=True),
                Check("partition matches time", lambda: quality.partition_matches_time(stg)),
            ]
        )

        def missing(rows: DataFrame, *columns: str) -> Check:
            return Check(f"not null: {', '.join(columns)}", lambda: rows.where(" or ".join(f"{c} is null" for c in columns)).select(*columns))

        def publish(database: str, name: str, rows: DataFrame, checks) -> DataFrame:
            if rows.columns != marts.MART_COLUMNS[name]:
                raise ColumnsDiffer(f"{name} has {rows.columns}")
            if "repo_id" in rows.columns:
                rows.repartition(BUCKETS, "repo_id").write.mode("overwrite").bucketBy(BUCKETS, "repo_id").sortBy("repo_id").saveAsTable(f"{database}.{name}_next")
            else:
                rows.write.mode("overwrite").format("parquet").saveAsTable(f"{database}.{name}_next")
            told.extend(quality.enforce(checks(spark.table(f"{database}.{name}_next"))))
            spark.sql(f"drop table if exists {database}.{name}")
            spark.sql(f"alter table {database}.{name}_next rename to {database}.{name}")
            return spark.table(f"{database}.{name}")

        eco = publish(PUBLISHED, "ecosystem_daily", marts.ecosystem_daily(stg), lambda t: [Check("ecosystem_daily sane", lambda: quality.ecosystem_sane(t)), Check("ecosystem_daily unique", lambda: quality.duplicates(t, "day")), missing(t, "day", "events", "repos", "actors")])
        repo = publish(PUBLISHED, "repo_daily", marts.repo_daily(stg), lambda t: [Check("repo_daily grain", lambda: quality.repo_grain(t)), Check("repo_daily counts", lambda: quality.repo_counts(t)), missing(t, "day", "repo_id", "events", "actors")])
        publish(RESTRICTED, "actor_daily", marts.actor_daily(stg), lambda t: [Check("actor_daily grain", lambda: quality.actor_grain(t)), Check("marts reconcile", lambda: quality.marts_reconcile(eco, repo, t)), missing(t, "day", "events", "repos")])
        publish(PUBLISHED, "repo_trending", marts.repo_trending(repo, eco, floor), lambda t: [
            Check("repo_trending grain", lambda: quality.trending_grain(t)), Check("repo_trending consistent", lambda: quality.trending_consistent(t, floor)), Check("repo_trending adjacent", lambda: quality.trending_adjacent(t, eco)),
        ])
    finally:
        files.delete(spark, path)
    return told

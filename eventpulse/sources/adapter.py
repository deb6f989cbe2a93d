"""The driver's ``events`` table seen as a lake of archived events.

The table has no repositories, so the envelope is derived: see ``ORACLE_CTE`` for the same rules in SQL. Some events have
no repository; a third of the users own one repository each; two days and three hours are missing; every tenth
event has a second copy one second later on the same day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The driver's event kinds as event types.
TYPES = {"view": "PushEvent", "click": "WatchEvent", "purchase": "ForkEvent", "signup": "IssuesEvent", "error": "PullRequestEvent"}
MISSING_DAYS = ("2024-01-11", "2024-01-12")
PARTIAL_DAY, MISSING_HOURS = "2024-01-20", 3


def lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the lake schema; nested objects are JSON text."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    ts = F.col("ts").cast("timestamp_ntz")
    kind = F.coalesce(*(F.when(F.col("event_type") == k, v) for k, v in TYPES.items()))
    k = F.get_json_object("props", "$.k").cast("bigint")
    letters = lambda n: F.translate((n + 10000).cast("string"), "0123456789", "abcdefghij")
    own = F.col("user_id") % 3 == 0
    shared = F.concat(F.lit("org"), (k % 7).cast("string"), F.when(k % 10 == 3, F.concat(F.lit("/"), letters(k))).otherwise(F.concat(F.lit("/repo-"), k.cast("string"), F.when(F.hour(ts) >= 12, "-renamed").otherwise(""))))
    repo = F.struct(F.when(own, F.col("user_id") + 1000).otherwise(k).alias("id"), F.when(own, F.concat(F.lit("own/"), letters(F.col("user_id")))).otherwise(shared).alias("name"))
    first = e.where(~(F.to_date(ts).isin(*(F.lit(d).cast("date") for d in MISSING_DAYS)) | ((F.to_date(ts) == F.lit(PARTIAL_DAY).cast("date")) & (F.hour(ts) < MISSING_HOURS)))).select(
        F.col("event_id").cast("string").alias("id"), kind.alias("type"),
        F.to_json(F.struct(F.col("user_id").alias("id"), F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("login"))).alias("actor"),
        F.when(F.col("event_id") % 500 != 7, F.to_json(repo)).alias("repo"), F.lit(None).cast("string").alias("org"), F.col("props").alias("payload"), F.lit(True).alias("public"), ts.alias("created_at"),
    )
    later = F.col("created_at") + F.expr("interval 1 second")
    # one pass over the table: each event yields itself, and every tenth a later copy
    copies = F.when(F.col("id").endswith("0"), F.array("created_at", F.when(F.to_date(later) == F.to_date("created_at"), later).otherwise(F.col("created_at")))).otherwise(F.array("created_at"))
    rows = first.select(*[c for c in first.columns if c != "created_at"], F.explode(copies).alias("created_at"))
    return rows.select("*", F.to_date("created_at").alias("dt"), F.hour("created_at").cast("bigint").alias("hr"))


#: The lake for DuckDB, nested objects already taken apart.
ORACLE_CTE = """
ev0 as (select event_id, user_id, cast(ts as timestamp) ts, event_type, cast(json_extract(props, '$.k') as bigint) k from events
  where cast(ts as date) not in (date '2024-01-11', date '2024-01-12') and not (cast(ts as date) = date '2024-01-20' and hour(ts) < 3)),
ev1 as (select cast(event_id as varchar) id,
  case event_type when 'view' then 'PushEvent' when 'click' then 'WatchEvent' when 'purchase' then 'ForkEvent' when 'signup' then 'IssuesEvent' when 'error' then 'PullRequestEvent' end as type,
  user_id actor_id, 'user' || user_id actor_login,
  case when event_id % 500 = 7 then null when user_id % 3 = 0 then user_id + 1000 else k end repo_id,
  case when event_id % 500 = 7 then null when user_id % 3 = 0 then 'own/' || translate(cast(user_id + 10000 as varchar), '0123456789', 'abcdefghij')
    when k % 10 = 3 then 'org' || (k % 7) || '/' || translate(cast(k + 10000 as varchar), '0123456789', 'abcdefghij')
    else 'org' || (k % 7) || '/repo-' || k || case when hour(ts) >= 12 then '-renamed' else '' end end repo_name,
  ts created_at from ev0),
lake as (select *, cast(created_at as date) dt, cast(hour(created_at) as bigint) hr from (
  select * from ev1 union all
  select * replace (case when cast(created_at + interval 1 second as date) = cast(created_at as date) then created_at + interval 1 second else created_at end as created_at) from ev1 where id like '%0'))"""

"""All registered queries over the driver's tables, each with the SQL that DuckDB checks it with.

``Tables`` derives the marts and a ledger from the adapter's lake once; plans stay lazy and share nothing but expressions.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventpulse.functions.events import BREAKOUTS, KNOWN_TYPES, bound
from eventpulse.operators import distinct, figures, ledger, marts, panels, quality, recon, staging
from eventpulse.plans import incremental
from eventpulse.sources import adapter, files
from eventpulse.sources import lake as lake_io
from eventpulse.streaming import live, wire

FIRST, LAST, HELD_OUT, NOW = "2024-01-01", "2024-01-30", "2024-01-29", "2024-02-01 00:00:00"
FIFO_ROWS = 500_000  # of the sequence that a trigger of exact deduplication takes, on average
BUSY, FLOOR = 3, 5  # the driver's tables are small: floors that leave something to rank


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def lake(self) -> DataFrame:
        return adapter.lake(self.spark, self.sf_dir)

    @cached_property
    def stg(self) -> DataFrame:
        return staging.stg_events(self.lake, payload=False)

    @cached_property
    def eco(self) -> DataFrame:
        return marts.ecosystem_daily(self.stg)

    @cached_property
    def repo(self) -> DataFrame:
        return marts.repo_daily(self.stg)

    @cached_property
    def act(self) -> DataFrame:
        return marts.actor_daily(self.stg)

    @cached_property
    def trend(self) -> DataFrame:
        return marts.repo_trending(self.repo, self.eco, FLOOR)

    @cached_property
    def hours(self) -> DataFrame:
        """(day, hour, n, k): rows of each lake hour; k numbers the hours of a month."""
        h = self.lake.groupBy(F.col("dt").alias("day"), F.col("hr").cast("int").alias("hour")).agg(F.count("*").alias("n"))
        return h.withColumn("k", F.dayofmonth("day") * 24 + F.col("hour"))

    @cached_property
    def ledger(self) -> DataFrame:
        """A ledger: ingested where the lake has the hour; of the others, two fifths are missing or failed and the rest unknown."""
        h = self.hours.select(F.col("day").alias("d"), F.col("hour").alias("h"), "n")
        every = ledger.calendar(self.spark, FIRST, LAST).join(h, (F.col("day") == F.col("d")) & (F.col("hour") == F.col("h")), "left")
        fifth = (F.dayofmonth("day") * 24 + F.col("hour")) % 5
        status = F.when(F.col("n").isNotNull(), "ingested").when(fifth == 0, "missing").when(fifth == 1, "failed")
        at = F.col("day").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("hour") + 1)
        return every.select("day", F.col("hour").cast("int").alias("hour"), status.alias("status"), F.col("n").alias("events"), (F.col("n") * 100).alias("bytes"), F.lit(None).cast("string").alias("detail"), at.alias("recorded_at")).where("status is not null")

    @cached_property
    def claims(self) -> DataFrame:
        """Claims on hours, some of them false: wrong counts, no size, hours that have no file."""
        k = F.col("k")
        real = self.hours.where(k % 17 != 0).select("day", "hour", (F.col("n") + F.when(k % 7 == 0, 1).otherwise(0)).alias("events"), F.when(k % 11 != 0, F.col("n") * 100).alias("bytes"))
        false = self.ledger.where("status = 'missing'").select("day", "hour", F.lit(1).cast("bigint").alias("events"), F.lit(100).cast("bigint").alias("bytes"))
        return real.union(false)

    @cached_property
    def found_files(self) -> DataFrame:
        return self.hours.select("day", "hour", (F.col("n") * 100 + F.when(F.col("k") % 13 == 0, 1).otherwise(0)).alias("bytes"))

    @cached_property
    def findings(self) -> DataFrame:
        return recon.verify(self.claims, self.found_files, self.hours.select("day", "hour", "n"))

    @cached_property
    def built(self) -> DataFrame:
        """Marts that lag: some days unbuilt, some an hour behind, some an hour ahead."""
        d = F.dayofmonth("day")
        return self.eco.where(d % 5 != 0).select("day", (F.col("hours_present") - F.when(d % 7 == 0, 1).otherwise(0) + F.when(d % 11 == 0, 1).otherwise(0)).alias("hours_present"), "events")

    @cached_property
    def messages(self) -> DataFrame:
        """Stream messages of the lake's distinct events: of fifty ids one is corrupt, one of another version, one of a wrong shape, one empty."""
        s = staging.stg_events(self.lake).where("repo_id is not null")
        text = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        rows = s.select(
            F.col("event_id").alias("id"), F.col("event_type").alias("type"), F.struct(F.col("actor_id").alias("id"), F.col("actor_login").alias("login")).alias("actor"), F.struct(F.col("repo_id").alias("id"), F.col("repo_name").alias("name")).alias("repo"),
            "payload", F.col("is_public").alias("public"), text("created_at").alias("created_at"), F.lit("2024-02-01T00:00:00Z").alias("captured_at"),
        )
        value = F.col("text")
        sent = bound(wire.encode(rows), text=F.col("value").cast("string"))
        sent = bound(sent, number=F.get_json_object(value, "$.event.id").cast("bigint") % 50)
        number = F.col("number")
        broken = (F.when(number == 1, F.substring(value, 1, 20)).when(number == 2, F.replace(value, F.lit('{"v":1,'), F.lit('{"v":99,'))).when(number == 3, F.replace(value, F.lit("Z\""), F.lit("\"")))
                  .when(number == 4, F.lit("")).otherwise(value)).cast("binary")
        return sent.select("key", broken.alias("value"))


_B = ", ".join(f"count(*) filter (type = '{t}') {c}" for c, t in BREAKOUTS.items())
_T = " + ".join(BREAKOUTS)
#: The lake, marts and ledger in DuckDB's SQL, as common table expressions.
CTE = f"""with {adapter.ORACLE_CTE},
stg as (select * exclude (n_) from (select *, row_number() over (partition by id order by created_at) n_ from lake) where n_ = 1),
eco as (select dt "day", count(*) events, count(distinct repo_id) repos, count(distinct actor_id) actors, {_B}, count(distinct hr) hours_present, count(*) filter (repo_id is null) events_without_repo, min(created_at) first_event_at, max(created_at) last_event_at from stg group by dt),
repo as (select dt "day", repo_id, arg_max(repo_name, (created_at, id)) repo_name, count(*) events, count(distinct actor_id) actors, {_B}, min(created_at) first_event_at, max(created_at) last_event_at from stg where repo_id is not null group by dt, repo_id),
act as (select dt "day", actor_id, arg_max(actor_login, (created_at, id)) actor_login, count(*) events, count(distinct repo_id) repos, {_B}, min(created_at) first_event_at, max(created_at) last_event_at from stg group by dt, actor_id),
pairs as (select a."day", b."day" prior_day from eco a join eco b on b."day" = a."day" - 1 where a.hours_present = 24 and b.hours_present = 24),
trend0 as (select t."day", t.repo_id, t.repo_name, t.actors, coalesce(p.actors, 0) actors_prior, t.actors - coalesce(p.actors, 0) actors_change,
  case when coalesce(p.actors, 0) = 0 then null else (t.actors - p.actors)::double / p.actors end actors_change_ratio, t.events, coalesce(p.events, 0) events_prior, p.repo_id is null absent_prior_day
  from repo t join pairs using ("day") left join repo p on p.repo_id = t.repo_id and p."day" = pairs.prior_day),
trend as (select *, row_number() over (partition by "day" order by actors_change desc, actors desc, repo_id) rank_in_day from trend0 where greatest(actors, actors_prior) >= {FLOOR}),
hours as (select dt "day", hr::int "hour", count(*) n, (day(dt) * 24 + hr)::int k from lake group by dt, hr),
calendar as (select d::date "day", h::int "hour" from unnest(generate_series(timestamp '{FIRST}', timestamp '{LAST}', interval 1 day)) a(d), unnest(range(0, 24)) b(h)),
ledger as (select * from (select "day", "hour", case when n is not null then 'ingested' when (day("day") * 24 + "hour") % 5 = 0 then 'missing' when (day("day") * 24 + "hour") % 5 = 1 then 'failed' end status, n events, n * 100 bytes,
  null::varchar detail, "day"::timestamp + to_hours("hour" + 1) recorded_at from calendar left join (select "day", "hour", n from hours) using ("day", "hour")) where status is not null),
claims as (select "day", "hour", n + case when k % 7 = 0 then 1 else 0 end events, case when k % 11 <> 0 then n * 100 end bytes from hours where k % 17 <> 0 union all select "day", "hour", 1, 100 from ledger where status = 'missing'),
found as (select "day", "hour", n * 100 + case when k % 13 = 0 then 1 else 0 end bytes from hours),
findings0 as (select coalesce(c."day", f."day") "day", coalesce(c."hour", f."hour")::int "hour", c.events, c.bytes, f.bytes f_bytes, h.n,
  case when c."day" is null then 'unrecorded' when f."day" is null then 'absent' when c.bytes is not null and c.bytes <> f.bytes then 'size' when h.n is null or h.n <> c.events then 'count' end problem
  from claims c full join found f on f."day" = c."day" and f."hour" = c."hour" left join hours h on h."day" = c."day" and h."hour" = c."hour"),
findings as (select "day", "hour", problem, case when problem = 'size' then bytes when problem in ('absent', 'count') then events end claimed, case when problem in ('size', 'unrecorded') then f_bytes when problem = 'count' then coalesce(n, 0) end actual from findings0 where problem is not null),
built as (select "day", hours_present - case when day("day") % 7 = 0 then 1 else 0 end + case when day("day") % 11 = 0 then 1 else 0 end hours_present, events from eco where day("day") % 5 <> 0),
repo_days as (select dt "day", repo_name repo, count(*) events, count(distinct actor_login) actors from lake where repo_name is not null group by all),
sent as (select *, id::bigint % 50 m from stg where repo_id is not null)
"""

_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(name: str, run: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
    _QUERIES[name] = run
    if sql:
        _SQL[name] = CTE + sql


# staging and marts
_query("stg_events_dedup", lambda t: t.stg.select("event_id", "event_type", "actor_id", "actor_login", "repo_id", "repo_name", "is_public", "created_at", "archive_day", "archive_hour"),
       "select id event_id, type event_type, actor_id, actor_login, repo_id, repo_name, true is_public, created_at, dt archive_day, hr archive_hour from stg")
_query("ecosystem_daily", lambda t: t.eco, "select * from eco")
_query("repo_daily", lambda t: t.repo, "select * from repo")
_query("actor_daily", lambda t: t.act, "select * from act")
_query("comparable_days", lambda t: marts.comparable_days(t.eco), 'select "day" from eco where hours_present = 24')
_query("adjacent_day_pairs", lambda t: marts.adjacent_day_pairs(t.eco), "select * from pairs")
_query("repo_trending", lambda t: t.trend, "select * from trend")
_query("ecosystem_daily_aggregate", lambda t: marts.ecosystem_aggregate(t.lake), "select * from eco")
_query("repo_daily_floor", lambda t: marts.repo_aggregate(t.lake, FLOOR), f"select *, {FLOOR}::int min_events from repo where events >= {FLOOR}")

# figures
_query("type_histogram", lambda t: figures.type_histogram(t.lake), "select type, count(*) n from lake group by type")
_query("type_histogram_top_pooled", lambda t: figures.top_types(t.lake, 3),
       "select label, sum(n)::bigint n from (select case when r <= 3 then type else (count(*) filter (r > 3) over ()) || ' other types' end as label, n from (select type, count(*) n, row_number() over (order by count(*) desc, type) r from lake group by type)) group by label")
_query("lake_overview", lambda t: figures.overview(t.lake), 'select count(*) events, count(distinct dt) "days", count(distinct (dt, hr)) "hours", count(distinct repo_name) repos, count(distinct actor_login) actors, count(distinct type) types from lake')
_query("lake_days", lambda t: figures.days(t.lake), 'select distinct dt "day" from lake')
_query("day_gaps", lambda t: figures.day_gaps(t.lake), 'select "day", ("day" - lag("day") over (order by "day"))::bigint gap from (select distinct dt "day" from lake)')
_query("per_repo_single_actor", lambda t: figures.per_repo_single_actor(t.lake),
       "select count(*) repos, count(*) filter (a = 1) single_actor_repos, sum(e)::bigint events, (sum(e) filter (a = 1))::bigint single_actor_events from (select repo_name, count(*) e, count(distinct actor_login) a from lake where repo_name is not null group by repo_name)")
_query("repo_days", lambda t: figures.repo_days(t.lake), "select * from repo_days")
_HIT = r"regexp_matches(split_part(repo, '/', 2), '^[a-z]{5,8}$')"
_query("per_day_automated_share", lambda t: figures.per_day_automated(t.lake, BUSY),
       f'select "day", count(*) repo_days, sum(events)::bigint events, count(*) filter (events >= {BUSY} and actors = 1) automated_repo_days, (sum(events) filter (events >= {BUSY} and actors = 1))::bigint automated_events, count(*) filter ({_HIT}) pattern_repo_days, (sum(events) filter ({_HIT}))::bigint pattern_events from repo_days group by "day"')
_SCORES = f"""scores as (select count(*) repo_days, sum(events)::bigint events, count(*) filter (events >= {BUSY}) busy_repo_days, count(*) filter (events >= {BUSY} and actors = 1) busy_single_actor, count(*) filter ({_HIT}) pattern_repo_days,
 (sum(events) filter ({_HIT}))::bigint pattern_events, count(*) filter (events >= {BUSY} and {_HIT}) rule_positives, count(*) filter (events >= {BUSY} and {_HIT} and actors = 1) rule_tp from repo_days where "day" = date '{HELD_OUT}')"""
_query("held_out_scores", lambda t: figures.held_out_scores(t.lake, HELD_OUT, BUSY), f", {_SCORES} select * from scores")
_query("held_out_rates", lambda t: figures.rates(figures.held_out_scores(t.lake, HELD_OUT, BUSY)),
       f", {_SCORES}, r as (select busy_single_actor::double / busy_repo_days base_rate, rule_tp::double / rule_positives as \"precision\", rule_tp::double / busy_single_actor recall from scores) select *, 2 * \"precision\" * recall / (\"precision\" + recall) f1, 2 * base_rate * 1.0 / (base_rate + 1.0) baseline_f1, \"precision\" / base_rate lift from r")
_query("watch_outside_automated", lambda t: figures.watches_outside_automated(t.lake, BUSY),
       f"select count(*) watches, count(*) filter (b.repo is null) watches_outside from lake l left join (select * from repo_days where events >= {BUSY} and actors = 1) b on b.\"day\" = l.dt and b.repo = l.repo_name where l.type = 'WatchEvent'")

# assertions, each also over planted defects so that an empty result isn't the only evidence
_twice = lambda df, where: df.union(df.where(where))
_query("assert_repo_grain", lambda t: quality.repo_grain(t.repo), 'select "day", repo_id, count(*) rows_at_this_key from repo group by all having count(*) > 1')
_query("assert_repo_grain_planted", lambda t: quality.repo_grain(_twice(t.repo, "repo_id % 10 = 3")), 'select "day", repo_id, 2::bigint rows_at_this_key from repo where repo_id % 10 = 3')
_query("assert_actor_grain", lambda t: quality.actor_grain(t.act), 'select "day", actor_id, count(*) rows_at_this_key from act group by all having count(*) > 1')
_query("assert_actor_grain_planted", lambda t: quality.actor_grain(_twice(t.act, "actor_id % 10 = 3")), 'select "day", actor_id, 2::bigint rows_at_this_key from act where actor_id % 10 = 3')
_SANE = f'select "day", events, repos, actors, hours_present, events_without_repo from {{}} where actors > events or repos > events or {_T} > events or events_without_repo > events or hours_present not between 1 and 24 or events <= 0'
_query("assert_ecosystem_sane", lambda t: quality.ecosystem_sane(t.eco), _SANE.format("eco"))
_query("assert_ecosystem_sane_planted", lambda t: quality.ecosystem_sane(t.eco.withColumn("hours_present", F.when(F.dayofmonth("day") % 4 == 0, 25).otherwise(F.col("hours_present")).cast("bigint"))),
       _SANE.format('(select * replace (case when day("day") % 4 = 0 then 25 else hours_present end as hours_present) from eco)'))
_COUNTS = f'select "day", repo_id, events, actors, {_T} typed_events from {{}} where actors > events or {_T} > events or events <= 0'
_query("assert_repo_counts", lambda t: quality.repo_counts(t.repo), _COUNTS.format("repo"))
_query("assert_repo_counts_planted", lambda t: quality.repo_counts(t.repo.withColumn("actors", F.when(F.col("repo_id") % 9 == 0, F.col("events") + 1).otherwise(F.col("actors")))),
       _COUNTS.format("(select * replace (case when repo_id % 9 = 0 then events + 1 else actors end as actors) from repo)"))
_RECONCILE = """select e."day", e.events ecosystem_events, e.events_without_repo, r.events repo_events, e.repos ecosystem_repos, r.repos repo_rows, e.actors ecosystem_actors, a.actors actor_rows from {} e
 full join (select "day", sum(events)::bigint events, count(*) repos from {} group by "day") r on r."day" = e."day" full join (select "day", count(*) actors from act group by "day") a on a."day" = e."day"
 where e.events - e.events_without_repo is distinct from r.events or e.repos is distinct from r.repos or e.actors is distinct from a.actors or e."day" is null or r."day" is null or a."day" is null"""
_query("assert_reconcile", lambda t: quality.marts_reconcile(t.eco, t.repo, t.act), _RECONCILE.format("eco", "repo"))
_query("assert_reconcile_planted", lambda t: quality.marts_reconcile(t.eco.where(F.dayofmonth("day") != 5), t.repo.where((F.dayofmonth("day") != 7) & ((F.dayofmonth("day") != 9) | (F.col("repo_id") % 2 == 0))), t.act),
       _RECONCILE.format('(select * from eco where day("day") <> 5)', '(select * from repo where day("day") <> 7 and (day("day") <> 9 or repo_id % 2 = 0))'))
_PARTITION = "select dt archive_day, hr archive_hour, id event_id, created_at from {} where dt <> cast(created_at as date) or hr <> hour(created_at)"
_query("assert_partition_time", lambda t: quality.partition_matches_time(t.stg), _PARTITION.format("stg"))
_query("assert_partition_time_planted", lambda t: quality.partition_matches_time(t.stg.withColumn("archive_hour", F.when(F.col("event_id").endswith("77"), F.lit(0)).otherwise(F.col("archive_hour")).cast("bigint"))),
       _PARTITION.format("(select * replace (case when id like '%77' then 0 else hr end as hr) from stg)"))
_ADJACENT = """select t."day", t."day" - 1 expected_prior_day, a."day" is null this_day_not_full, b."day" is null prior_day_not_full from (select distinct "day" from {}) t
 left join (select "day" from eco where hours_present = 24) a on a."day" = t."day" left join (select "day" from eco where hours_present = 24) b on b."day" = t."day" - 1 where a."day" is null or b."day" is null"""
_query("assert_trending_adjacent", lambda t: quality.trending_adjacent(t.trend, t.eco), _ADJACENT.format("trend"))
_query("assert_trending_adjacent_planted", lambda t: quality.trending_adjacent(t.repo, t.eco), _ADJACENT.format("repo"))
_GRAIN = """select "day", repo_id, n rows_for_key, null::bigint rows_in_day, null::bigint distinct_ranks from (select "day", repo_id, count(*) n from {0} group by all having count(*) > 1)
 union all select "day", null, null, n, d from (select "day", count(*) n, count(distinct rank_in_day) d, min(rank_in_day) low from {0} group by "day") where n <> d or low <> 1"""
_query("assert_trending_grain", lambda t: quality.trending_grain(t.trend), _GRAIN.format("trend"))
_query("assert_trending_grain_planted", lambda t: quality.trending_grain(_twice(t.trend, "rank_in_day = 2 and dayofmonth(day) % 3 = 0")), _GRAIN.format('(select * from trend union all select * from trend where rank_in_day = 2 and day("day") % 3 = 0)'))
_CONSISTENT = f"""select "day", repo_id, actors, actors_prior, actors_change, actors_change_ratio, absent_prior_day from {{}} where actors_change is distinct from actors - actors_prior or actors < 1 or actors_prior < 0
 or greatest(actors, actors_prior) < {FLOOR} or actors > events or actors_prior > events_prior or absent_prior_day <> (actors_prior = 0) or (actors_prior = 0 and actors_change_ratio is not null) or (actors_prior > 0 and actors_change_ratio is null)"""
_query("assert_trending_consistent", lambda t: quality.trending_consistent(t.trend, FLOOR), _CONSISTENT.format("trend"))
_query("assert_trending_consistent_planted", lambda t: quality.trending_consistent(t.trend.withColumn("actors_change", F.when(F.col("rank_in_day") == 1, None).otherwise(F.col("actors_change")).cast("bigint")), FLOOR),
       _CONSISTENT.format("(select * replace (case when rank_in_day = 1 then null else actors_change end as actors_change) from trend)"))
_query("generic_unique", lambda t: quality.duplicates(t.stg, "event_id"), "select id event_id, count(*) rows_at_this_key from stg group by id having count(*) > 1")
_query("generic_unique_raw", lambda t: quality.duplicates(staging.staged(t.lake), "event_id"), "select id event_id, count(*) rows_at_this_key from lake group by id having count(*) > 1")
_query("generic_not_null_threshold", lambda t: quality.nulls(t.stg, "event_id", "repo_id", "org_login"),
       "select * from (select 'event_id' as \"column\", 0::bigint nulls, 'ok' severity union all select 'repo_id', n, case when n > 100 then 'error' when n > 0 then 'warn' else 'ok' end from (select count(*) n from stg where repo_id is null) union all select 'org_login', n, case when n > 100 then 'error' when n > 0 then 'warn' else 'ok' end from (select count(*) n from stg))")
_KNOWN = ", ".join(f"'{k}'" for k in KNOWN_TYPES)
_query("accepted_event_types", lambda t: quality.unknown_types(t.stg), f"select type event_type, count(*) n from stg where type not in ({_KNOWN}) group by type")
_query("accepted_event_types_planted", lambda t: quality.unknown_types(t.stg.withColumn("event_type", F.when(F.col("event_type") == "ForkEvent", "SpoonEvent").otherwise(F.col("event_type")))), "select 'SpoonEvent' event_type, count(*) n from stg where type = 'ForkEvent' having count(*) > 0")

# ledger and reconciliation
_query("pending_hours", lambda t: ledger.pending_hours(t.spark, t.ledger, FIRST, LAST), 'select "day", "hour" from calendar left join ledger using ("day", "hour") where status is null')
_query("pending_hours_retry_failed", lambda t: ledger.pending_hours(t.spark, t.ledger, FIRST, LAST, True), "select \"day\", \"hour\" from calendar left join ledger using (\"day\", \"hour\") where status is null or status = 'failed'")
_query("due_hours", lambda t: ledger.due_hours(ledger.pending_hours(t.spark, t.ledger, FIRST, LAST), "2024-01-12 06:00:00"),
       "select \"day\", \"hour\" from calendar left join ledger using (\"day\", \"hour\") where status is null and \"day\"::timestamp + to_hours(\"hour\" + 1) <= timestamp '2024-01-12 06:00:00'")
_query("ledger_status_counts", lambda t: ledger.status_counts(t.ledger), "select status, count(*) \"hours\", coalesce(sum(events), 0)::bigint events from ledger group by status")


def _records(t: Tables) -> DataFrame:
    """New records on every fourth hour: failed ones, which must not replace an ingested hour, and fresh counts on others."""
    fresh = F.col("hour") % 8 == 0
    rows = ledger.calendar(t.spark, FIRST, LAST).where(F.col("hour") % 4 == 0)
    return rows.select("day", F.col("hour").cast("int").alias("hour"), F.when(fresh, "ingested").otherwise("failed").alias("status"), F.when(fresh, F.lit(5)).cast("bigint").alias("events"), F.when(fresh, F.lit(500)).cast("bigint").alias("bytes"), F.lit("again").alias("detail"), F.lit(NOW).cast("timestamp_ntz").alias("recorded_at"))


_query("ledger_upsert_no_downgrade", lambda t: ledger.upsert(t.ledger, _records(t)),
       f"""select coalesce(l."day", c."day") "day", coalesce(l."hour", c."hour")::int "hour", case when u then case when c."hour" % 8 = 0 then 'ingested' else 'failed' end else l.status end status, case when u then case when c."hour" % 8 = 0 then 5 end else l.events end events,
 case when u then case when c."hour" % 8 = 0 then 500 end else l.bytes end bytes, case when u then 'again' else l.detail end detail, case when u then timestamp '{NOW}' else l.recorded_at end recorded_at
 from (select *, c."hour" % 4 = 0 and (c."hour" % 8 = 0 or l.status is distinct from 'ingested') u from calendar c left join ledger l using ("day", "hour")) z(dd, hh, status, events, bytes, detail, recorded_at, u), lateral (select dd "day", hh "hour") c, lateral (select dd "day", hh "hour", z.status, z.events, z.bytes, z.detail, z.recorded_at) l where u or z.status is not null""")  # fmt: skip
_query("ledger_forget_returning", lambda t: ledger.forget(t.ledger, ledger.calendar(t.spark, FIRST, LAST).where("hour < 3"))[1].select("day", "hour", "events", "bytes"), "select \"day\", \"hour\", events, bytes from ledger where status = 'ingested' and \"hour\" < 3")
_query("verify_lake", lambda t: t.findings, "select * from findings")
_query("verify_unbacked", lambda t: recon.unbacked(t.findings), "select * from findings where problem <> 'unrecorded'")


def _refetched(t: Tables) -> DataFrame:
    bad = recon.unbacked(t.findings).select("day", "hour")
    h = t.hours.select(F.col("day").alias("d"), F.col("hour").alias("h"), "n")
    met = bad.join(h, (F.col("day") == F.col("d")) & (F.col("hour") == F.col("h")), "left")
    return met.select("day", "hour", F.when(F.col("n").isNull(), "missing").otherwise("ingested").alias("status"), F.col("n").alias("events"))


_query("repair_reconciliation", lambda t: recon.reconcile_repairs(t.claims, _refetched(t)),
       """select f."day", f."hour", c.events claimed, h.n actual, case when h.n is null then 'NOT RECOVERED' when h.n = c.events then 'match' else 'DIFFERS' end verdict
 from findings f join claims c using ("day", "hour") left join hours h using ("day", "hour") where problem <> 'unrecorded'""")  # fmt: skip
_query("marts_freshness", lambda t: recon.marts_freshness(t.hours.groupBy("day").agg(F.count("*").alias("hours")), t.built),
       """select coalesce(l."day", b."day") "day", coalesce(l.h, 0)::bigint lake_hours, b.hours_present mart_hours, case when b."day" is null then 'unbuilt' when b.hours_present < coalesce(l.h, 0) then 'behind' when b.hours_present > coalesce(l.h, 0) then 'surplus' else 'current' end kind,
 greatest(coalesce(l.h, 0) - coalesce(b.hours_present, 0), 0)::bigint hours_behind from (select "day", count(*) h from hours group by "day") l full join built b on b."day" = l."day\"""")  # fmt: skip
_query("history_missing_days", lambda t: recon.missing_days(t.built), 'select "day" from (select unnest(generate_series(min("day")::timestamp, max("day")::timestamp, interval 1 day))::date "day" from built) where "day" not in (select "day" from built)')
_query("history_status", lambda t: recon.history_status(t.built, "2024-02-03"),
       """select count(*) "days", min("day") first_day, max("day") last_day, date '2024-02-01' expected_latest, count(*) filter (hours_present < 24) partial_days, (max("day") - min("day") + 1 - count(*))::bigint missing_days, false as "empty", max("day") < date '2024-02-01' stalled,
 max("day") - min("day") + 1 > count(*) holed, max("day") >= date '2024-02-01' and max("day") - min("day") + 1 = count(*) healthy, greatest(date '2024-02-01' - max("day"), 0)::bigint stale_by_days from built""")  # fmt: skip
_MEDIAN = "(select (list_sort(list(events)))[(count(*) // 2 + 1)::int] from eco)"
_query("history_volume", lambda t: recon.history_volume(t.eco), f"select min(events) least, {_MEDIAN} median, max(events) most, count(*) filter (2 * events < {_MEDIAN}) thin_days from eco")
_query("history_thin_days", lambda t: recon.thin_days(t.eco.withColumn("events", F.when(F.dayofmonth("day") % 6 == 0, (F.col("events") / 3).cast("bigint")).otherwise(F.col("events")))),
       'select "day", events, median from (select *, (select (list_sort(list(events)))[(count(*) // 2 + 1)::int] from x) median from x) where 2 * events < median'.replace("from x)", 'from (select "day", case when day("day") % 6 = 0 then trunc(events / 3)::bigint else events end events from eco))').replace("from x)", "from eco)").replace("median from x", 'median from (select "day", case when day("day") % 6 = 0 then trunc(events / 3)::bigint else events end events from eco)'))
_query("capture_overlap", lambda t: recon.capture_overlap(t.lake.where("substr(id, -1) < '6'").select("id").union(t.lake.where("id like '%1'").select(F.concat(F.lit("x"), "id"))), t.lake.where("hr < 18").select("id")),
       ", l as (select id from lake where right(id, 1) < '6' union select 'x' || id from lake where id like '%1'), a as (select distinct id from lake where hr < 18), n as (select (select count(*) from l) live_ids, (select count(*) from a) archive_ids, (select count(*) from l join a using (id)) matched) select *, matched::double / archive_ids capture_rate from n")

# dashboard panels
_LATEST = '"day" = (select max("day") from trend)'
_query("panel_hours_ingested", lambda t: panels.hours_ingested(t.ledger), "select count(*) \"value\" from ledger where status = 'ingested'")
_query("panel_hours_outstanding", lambda t: panels.hours_outstanding(t.ledger), "select count(*) \"value\" from ledger where status in ('missing', 'failed')")
_query("panel_freshness_hours", lambda t: panels.freshness_hours(t.ledger, NOW), f"select date_diff('second', max(\"day\"::timestamp + to_hours(\"hour\")), timestamp '{NOW}') / 3600.0::double \"value\" from ledger where status = 'ingested'")
_query("panel_events_recorded", lambda t: panels.events_recorded(t.ledger), "select coalesce(sum(events), 0)::bigint \"value\" from ledger where status = 'ingested'")
_query("panel_hours_not_built", lambda t: panels.hours_not_built(t.ledger, t.built),
       "select coalesce(sum(h - coalesce(hours_present, 0)), 0)::bigint hours_not_built from (select \"day\", count(*) h from ledger where status = 'ingested' and events > 0 group by \"day\") left join built using (\"day\") where hours_present is null or hours_present < h")
_query("panel_coverage", lambda t: panels.coverage(t.eco, "2024-01-05", "2024-01-25"), "select \"day\", hours_present hours_held from eco where \"day\" between date '2024-01-05' and date '2024-01-25'")
_query("panel_daily_totals", lambda t: panels.daily_totals(t.eco, "2024-01-05", "2024-01-25"), "select \"day\", events, repos repositories, actors accounts from eco where \"day\" between date '2024-01-05' and date '2024-01-25'")
_query("panel_recent_hours", lambda t: panels.recent_hours(t.ledger), 'select * from ledger order by "day" desc, "hour" desc limit 50')
_query("panel_days_comparable", lambda t: panels.days_comparable(t.trend), 'select count(distinct "day") "days" from trend')
_query("panel_ranked_latest", lambda t: panels.ranked_latest(t.trend), f"select count(*) repositories from trend where {_LATEST}")
_query("panel_largest_gain", lambda t: panels.largest_gain(t.trend), f"select coalesce(max(actors_change), 0)::bigint accounts from trend where {_LATEST}")
_query("panel_first_appearance", lambda t: panels.first_appearances(t.trend), f"select count(*) repositories from trend where absent_prior_day and {_LATEST}")
_query("panel_gainers", lambda t: panels.gainers(t.trend), f"select rank_in_day, repo_name, actors_prior, actors, actors_change, round(actors_change_ratio, 2) proportional from trend where {_LATEST} and actors_change > 0 order by rank_in_day limit 25")
_query("panel_losers", lambda t: panels.losers(t.trend), f"select repo_name, actors_prior, actors, actors_change, round(actors_change_ratio, 2) proportional from trend where {_LATEST} and actors_change < 0 order by actors_change, actors_prior desc, repo_id limit 25")
_query("panel_gain_lose_counts", lambda t: panels.movement_by_day(t.trend), 'select "day", count(*) filter (actors_change > 0) gaining, count(*) filter (actors_change < 0) losing, count(*) filter (actors_change = 0) unchanged from trend group by "day"')

# the live path
_REASON = "case when m = 1 or m = 4 then 'corrupt' when m = 2 then 'unsupported_version' when m = 3 then 'invalid_shape' end"
_query("stream_route_counts", lambda t: wire.triage(t.messages).groupBy(F.coalesce("reason", F.lit("stored")).alias("route")).agg(F.count("*").alias("n")), f"select coalesce({_REASON}, 'stored') route, count(*) n from sent group by 1")
_query("stream_dead_letters", lambda t: wire.decode_dead_letters(wire.dead_letters(wire.triage(t.messages).where("reason is not null"))).groupBy("reason", "detail").agg(F.count("*").alias("n"), F.count_if(F.length("value") == 0).alias("without_value")),
       f"select {_REASON} reason, case when m in (1, 4) then 'value is not JSON text' when m = 2 then 'not a version 1 envelope' else 'envelope lacks a valid event' end detail, count(*) n, count(*) filter (m = 4) without_value from sent where m between 1 and 4 group by 1, 2")


def _stored_twice(t: Tables) -> DataFrame:
    """All messages delivered through a file stream, and then delivered once more: what the store holds."""
    base = files.shared_dir(t.spark)
    t.messages.write.parquet(f"{base}/messages")
    store = live.Store(t.spark, f"{base}/store")
    for nth in range(2):
        live.consume(live.file_messages(t.spark, f"{base}/messages"), store, f"{base}/dead", f"{base}/checkpoint-{nth}", Counter()).awaitTermination()
    return store.read().select("event_id", "type", "actor_id", "actor_login", "repo_id", "repo_name", F.col("created_at").cast("timestamp_ntz").alias("created_at"), "payload")


_query("stream_store_idempotent", _stored_twice, "select id event_id, type, actor_id, actor_login, repo_id, repo_name, created_at, (select any_value(replace(props, ' ', '')) from events e where e.event_id::varchar = id) payload from sent where m not between 1 and 4")
_query("stream_hourly_buckets", lambda t: wire.store_rows(wire.triage(t.messages).where("reason is null")).groupBy(wire.hour_key(F.col("created_at")).alias("hour_key")).agg(F.count("*").alias("n")), "select strftime(created_at, '%Y-%m-%d-%H') hour_key, count(*) n from sent where m not between 1 and 4 group by 1")


def _fifo(t: Tables) -> DataFrame:
    """Exact first-in-first-out deduplication of the lake's ids in order of time, over a file stream."""
    base = files.shared_dir(t.spark)
    seq = F.unix_micros(F.col("created_at").cast("timestamp"))
    rows = t.lake.select("id", seq.alias("seq"))
    parts = max(8, -(-rows.count() // FIFO_ROWS))
    ordered = rows.repartitionByRange(parts, "seq").withColumn("part", F.spark_partition_id())
    ordered.write.partitionBy("part").parquet(f"{base}/dealt")
    # files in order of time, so that the order of triggers is the order of the sequence; one a trigger, so that none holds more than a file
    for k in range(parts):
        if files.exists(t.spark, f"{base}/dealt/part={k}"):
            t.spark.read.schema("id string, seq bigint").parquet(f"{base}/dealt/part={k}").coalesce(1).sortWithinPartitions("seq").write.mode("append").parquet(f"{base}/ids")
    live.fifo_dedup(live.file_ids(t.spark, f"{base}/ids", 1), 1000).writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start(f"{base}/fresh").awaitTermination()
    return t.spark.read.schema("id string, seq bigint").parquet(f"{base}/fresh")


_query("stream_fifo_dedup", _fifo)


def _archives(t: Tables, base: str, where: str = "true") -> list[tuple[str, str, int]]:
    """The lake's hours as gzip NDJSON archives, one folder each: (path, day, hour)."""
    rows = t.lake.where(where).select("dt", "hr", "id", "type", F.parse_json("actor").alias("actor"), F.parse_json("repo").alias("repo"), F.parse_json("payload").alias("payload"), "public", F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("created_at"))
    rows.repartition("dt", "hr").write.partitionBy("dt", "hr").option("compression", "gzip").json(f"{base}/archive")
    told = [(path, *(x.partition("=")[2] for x in path.split("/")[-2:])) for path, _ in files.glob(t.spark, f"{base}/archive/dt=*/hr=*")]
    return [(path, day, int(hour)) for path, day, hour in told]


def _written(t: Tables, base: str, where: str = "true") -> str:
    """Those archives converted hour by hour into a lake, several at a time."""
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda x: lake_io.write_hour(t.spark, x[0], f"{base}/lake", x[1], x[2]), _archives(t, base, where)))
    return f"{base}/lake"


def _roundtrip(t: Tables) -> DataFrame:
    """Every hour of the lake written as an archive and then as a lake file, read back."""
    back = lake_io.read_lake(t.spark, _written(t, files.shared_dir(t.spark)))
    return back.select("id", "type", F.col("created_at").cast("timestamp_ntz").alias("created_at"), "dt", "hr")


_query("write_hour_roundtrip", _roundtrip, "select id, type, created_at, dt, hr from lake")


def _aggregated(t: Tables) -> DataFrame:
    """A complete day's hours written, then its permanent repository aggregate, read back from the history."""
    base, day = files.shared_dir(t.spark), "2024-01-08"
    lake_io.aggregate_day(t.spark, _written(t, base, f"dt = date '{day}'"), f"{base}/aggregates", day, BUSY)
    return lake_io.read_history(t.spark, f"{base}/aggregates", "repo", "day date").select("day", "repo_id", "repo_name", "events", "actors", *BREAKOUTS, "min_events")


_query("aggregate_day_roundtrip", _aggregated, f"""select dt "day", repo_id, arg_max(repo_name, (created_at, id)) repo_name, count(*) events, count(distinct actor_id) actors, {_B}, {BUSY} min_events from
 (select * from (select *, row_number() over (partition by dt, id order by created_at) k_ from lake where dt = date '2024-01-08') where k_ = 1) where repo_id is not null group by dt, repo_id having count(*) >= {BUSY}""")


def _history(t: Tables) -> DataFrame:
    """Daily aggregates of two shapes, a column having come later, united by name."""
    base = f"{files.shared_dir(t.spark)}/aggregates"
    for day, later in (("2024-01-05", False), ("2024-01-06", True)):
        rows = t.eco.where(F.col("day") == F.lit(day).cast("date")).select("day", "events", "hours_present", *(["repos"] if later else []))
        rows.coalesce(1).write.parquet(f"{base}/_staging/{day}")
        path, _ = files.glob(t.spark, f"{base}/_staging/{day}/part-*.parquet")[0]
        files.rename(t.spark, path, f"{base}/ecosystem/dt={day}/ecosystem_daily.parquet")
    return lake_io.read_history(t.spark, base, "ecosystem", "day date").select("day", "events", "hours_present", "repos")


_query("history_union", _history, 'select "day", events, hours_present, case when "day" = date \'2024-01-06\' then repos end repos from eco where "day" in (date \'2024-01-05\', date \'2024-01-06\')')
_query("counts_by_hour", lambda t: lake_io.counts_by_hour(t.spark, _laid_out(t, files.shared_dir(t.spark))), 'select dt "day", hr "hour", count(*) n from lake group by dt, hr')


def _watermarked(t: Tables) -> DataFrame:
    """The lake through the watermark-bounded deduplication; copies are a second apart and the delay is two hours, so each id stays once."""
    base = files.shared_dir(t.spark)
    t.lake.select("id", F.col("created_at").cast("timestamp").alias("created_at")).write.parquet(f"{base}/events")
    stream = t.spark.readStream.schema("id string, created_at timestamp").parquet(f"{base}/events")
    live.watermark_dedup(stream, "2 hours").select("id").writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start(f"{base}/fresh").awaitTermination()
    return t.spark.read.schema("id string").parquet(f"{base}/fresh")


_query("watermark_dedup", _watermarked, "select distinct id from lake")
_query("day_span", lambda t: figures.day_span(t.lake), "select max(dt) - min(dt) + 1 span from lake")
_query("pooled_share", lambda t: figures.pooled_share(figures.per_day_automated(t.lake, BUSY)),
       f""", rd as (select dt, repo_name, count(*) n, count(distinct actor_login) a from lake where repo_name is not null group by dt, repo_name),
 d as (select dt, sum(n) e, sum(case when n >= {BUSY} and a = 1 then n else 0 end) au, sum(case when regexp_full_match(split_part(repo_name, '/', 2), '[a-z]{{5,8}}') then n else 0 end) pa from rd group by dt)
 select 100.0 * sum(pa)::double / sum(e)::double pattern_percent, 100.0 * sum(au)::double / sum(e)::double automated_percent, max(100.0 * au::double / e::double) - min(100.0 * au::double / e::double) automated_points from d""")  # fmt: skip
_query("figures_agree", lambda t: figures.agreement(figures.per_day_automated(t.lake, BUSY), figures.held_out_scores(t.lake, HELD_OUT, BUSY), HELD_OUT).select("figure", F.coalesce("by_day", F.lit(0)).cast("bigint").alias("by_day"), "agrees"),
       f""", rd as (select repo_name, count(*) n, regexp_full_match(split_part(repo_name, '/', 2), '[a-z]{{5,8}}') hit from lake where repo_name is not null and dt = date '{HELD_OUT}' group by repo_name)
 select unnest(['events', 'repo_days', 'pattern_events', 'pattern_repo_days']) figure, unnest([sum(n)::bigint, count(*), coalesce(sum(n) filter (hit), 0)::bigint, count(*) filter (hit)]) by_day, true agrees from rd""")  # fmt: skip


def _laid_out(t: Tables, root: str, where: str = "true") -> str:
    """The lake's hours as lake files, one an hour, written in one pass."""
    base = files.shared_dir(t.spark)
    rows = t.lake.where(where).withColumn("created_at", F.col("created_at").cast("timestamp")).withColumns({"_dt": F.col("dt"), "_hr": F.col("hr")})
    rows.repartition("_dt", "_hr").write.partitionBy("_dt", "_hr").parquet(base)
    for path, _ in files.glob(t.spark, f"{base}/_dt=*/_hr=*/part-*.parquet"):
        day, hour = (x.partition("=")[2] for x in path.split("/")[-3:-1])
        files.rename(t.spark, path, f"{lake_io.partition_dir(root, day, int(hour))}/events.parquet")
    files.delete(t.spark, base)
    return root


def _partials(t: Tables, stg: DataFrame) -> distinct.DistinctStore:
    """Partials of all days but one, to which that one is then added. The staged events are written once, by day, so that neither addition stages them again."""
    base, late = files.shared_dir(t.spark), F.col("archive_day") == F.lit(HELD_OUT).cast("date")
    stg.write.partitionBy("archive_day").parquet(f"{base}/staged")
    rows, store = t.spark.read.schema(stg.schema).parquet(f"{base}/staged"), distinct.DistinctStore(t.spark, f"{base}/store")
    store.add(rows.where(~late))
    store.add(rows.where(late))
    return store


_query("overview_from_partials", lambda t: _partials(t, staging.staged(t.lake, False)).overview(), _SQL["lake_overview"].removeprefix(CTE))
_query("ecosystem_from_partials", lambda t: _partials(t, staging.stg_events(t.lake, "day", payload=False)).ecosystem_daily(), "select * from eco")


def _converged(t: Tables, mart: str) -> DataFrame:
    """Marts of a lake that lacks an hour, then brought up to it by a second pass."""
    base, hour = files.shared_dir(t.spark), "dt = date '2024-01-15' and hr = 5"
    root = _laid_out(t, f"{base}/lake", f"not ({hour})")
    incremental.converge(t.spark, root, f"{base}/marts", FLOOR)
    _laid_out(t, root, hour)
    incremental.converge(t.spark, root, f"{base}/marts", FLOOR)
    return incremental.read(t.spark, f"{base}/marts", mart)


_query("marts_converged_ecosystem", lambda t: _converged(t, "ecosystem_daily"), "select * from eco")
_query("marts_converged_trending", lambda t: _converged(t, "repo_trending"), "select * from trend")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, run=run: run(Tables(spark, sf_dir))) for name, run in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)

"""Marts, figures, ledger and reconciliation on small rows made for the hard cases."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from eventpulse.functions.events import LAKE, short_name_matches
from eventpulse.operators import figures, ledger, marts, panels, quality, recon, staging
from eventpulse.operators.quality import AssertionFailed, Check


def event(i, kind, at, actor=1, repo=(2, "o/r"), day=None, hour=None, login=None):
    from datetime import date, datetime

    t = datetime.fromisoformat(at) if at else None
    return (i, kind, f'{{"id":{actor},"login":"{login or f"u{actor}"}"}}', None if repo is None else f'{{"id":{repo[0]},"name":"{repo[1]}"}}', None, "{}", True, t, date.fromisoformat(day) if day else t.date(), hour if hour is not None else t.hour)


def lake(spark, *events):
    return spark.createDataFrame(list(events), LAKE)


def test_duplicates_keep_the_earliest_and_undated_rows_come_last(spark):
    rows = lake(spark, event("1", "PushEvent", "2026-07-22T05:00:00"), event("1", "WatchEvent", "2026-07-22T04:00:00"), event("1", "ForkEvent", None, day="2026-07-22", hour=0), event("2", "PushEvent", "2026-07-22T05:00:00"))
    got = {r.event_id: r.event_type for r in staging.stg_events(rows).collect()}
    assert got == {"1": "WatchEvent", "2": "PushEvent"}
    apart = lake(spark, event("1", "PushEvent", "2026-07-22T23:59:59"), event("1", "PushEvent", "2026-07-23T00:00:01"))
    assert staging.stg_events(apart).count() == 1 and staging.stg_events(apart, "day").count() == 2


def test_no_repository_is_counted_and_never_grouped(spark):
    stg = staging.stg_events(lake(spark, event("1", "PushEvent", "2026-07-22T05:00:00", repo=None), event("2", "WatchEvent", "2026-07-22T06:00:00")))
    e = marts.ecosystem_daily(stg).first()
    assert (e.events, e.repos, e.events_without_repo, e.hours_present, e.pushes, e.stars) == (2, 1, 1, 2, 1, 1)
    assert marts.repo_daily(stg).count() == 1
    assert set(marts.MART_COLUMNS["repo_daily"]) == set(marts.repo_daily(stg).columns)


def test_a_rename_keeps_the_latest_name_that_is_known(spark):
    rows = [event("1", "PushEvent", "2026-07-22T05:00:00", repo=(2, "old/n")), event("2", "PushEvent", "2026-07-22T06:00:00", repo=(2, "new/n"))]
    nameless = ("3", "PushEvent", '{"id":1,"login":"u"}', '{"id":2}', None, "{}", True, rows[0][7].replace(hour=9), rows[0][8], 9)
    assert marts.repo_daily(staging.stg_events(lake(spark, *rows, nameless))).first().repo_name == "new/n"


def test_trending_needs_calendar_neighbours_and_ranks_after_the_floor(spark):
    eco = spark.createDataFrame([("2026-01-01", 24), ("2026-01-02", 24), ("2026-01-03", 23), ("2026-01-04", 24), ("2026-01-06", 24)], "day string, hours_present bigint").selectExpr("cast(day as date) day", "hours_present")
    assert [str(r.day) for r in marts.adjacent_day_pairs(eco).collect()] == ["2026-01-02"]
    repo = spark.createDataFrame([("2026-01-01", 1, "a", 4, 9), ("2026-01-02", 1, "a", 6, 9), ("2026-01-02", 2, "b", 5, 5), ("2026-01-02", 3, "c", 4, 4), ("2026-01-01", 4, "d", 9, 9), ("2026-01-02", 5, "e", 5, 7)], "day string, repo_id bigint, repo_name string, actors bigint, events bigint").selectExpr("cast(day as date) day", "repo_id", "repo_name", "actors", "events")
    got = {r.repo_id: r for r in marts.repo_trending(repo, eco).collect()}
    assert set(got) == {1, 2, 5}  # under the floor, or gone today: no row
    assert [(got[k].rank_in_day, got[k].actors_change) for k in (2, 5, 1)] == [(1, 5), (2, 5), (3, 2)]
    assert got[2].absent_prior_day and got[2].actors_change_ratio is None and got[1].actors_change_ratio == 0.5


def test_figures_count_names_and_copies(spark):
    rows = lake(spark, event("1", "PushEvent", "2026-07-22T05:00:00"), event("1", "PushEvent", "2026-07-22T05:00:00"), event("2", "WatchEvent", "2026-07-22T06:00:00", repo=None))
    o = figures.overview(rows).first()
    assert (o.events, o.repos, o.actors, o.hours, o.types) == (3, 1, 1, 2, 2)
    assert tuple(figures.watches_outside_automated(rows, 2).first()) == (1, 1)
    with pytest.raises(PySparkException, match="busy_repo_days"):
        figures.rates(figures.held_out_scores(rows, "2020-01-01")).collect()


def test_short_names(spark):
    names = ["o/abcde", "o/abcd", "o/abcdefghi", "o/ABCDE", "abcde", "o/abcde\n", "o/abc1e", "x/abcdefgh/z"]
    got = [r.hit for r in spark.createDataFrame([(n,) for n in names], "n string").select(short_name_matches(F.col("n")).alias("hit")).collect()]
    assert got == [True, False, False, False, False, False, False, True]


def hours(spark, *rows):
    return spark.createDataFrame([(d, h, s, n, n and n * 10, None, at) for d, h, s, n, at in rows], "day string, hour int, status string, events bigint, bytes bigint, detail string, recorded_at string").selectExpr("cast(day as date) day", "cast(hour as smallint) hour", "status", "events", "bytes", "detail", "cast(recorded_at as timestamp) recorded_at")


def test_an_ingested_hour_is_never_downgraded(spark):
    old = hours(spark, ("2026-01-01", 0, "ingested", 5, "2026-01-01"), ("2026-01-01", 1, "missing", None, "2026-01-01"), ("2026-01-01", 2, "ingested", 5, "2026-01-01"))
    new = hours(spark, ("2026-01-01", 0, "failed", None, "2026-01-02"), ("2026-01-01", 1, "ingested", 7, "2026-01-02"), ("2026-01-01", 2, "ingested", 6, "2026-01-02"), ("2026-01-01", 3, "failed", None, "2026-01-02"))
    assert {r.hour: (r.status, r.events) for r in ledger.upsert(old, new).collect()} == {0: ("ingested", 5), 1: ("ingested", 7), 2: ("ingested", 6), 3: ("failed", None)}
    bad = hours(spark, ("2026-01-01", 99, "missing", None, None), ("2026-01-01", 1, "ingested", None, None), ("2026-01-01", 1, "odd", 1, None), ("2026-01-01", 1, "failed", None, None))
    assert ledger.invalid(bad).count() == 3


def test_pending_hours_and_a_reversed_range(spark):
    known = hours(spark, ("2026-01-01", 0, "ingested", 5, None), ("2026-01-01", 1, "missing", None, None), ("2026-01-01", 2, "failed", None, None))
    assert [r.hour for r in ledger.pending_hours(spark, known, "2026-01-01", "2026-01-01").orderBy("hour").collect()] == list(range(3, 24))
    retry = ledger.pending_hours(spark, known, "2026-01-01", "2026-01-01", True)
    assert retry.count() == 22 and [r.hour for r in ledger.due_hours(retry, "2026-01-01 04:00:00").orderBy("hour").collect()] == [2, 3]
    assert ledger.pending_hours(spark, known, "2026-01-02", "2026-01-01").count() == 0


def test_upper_median_and_thin_days(spark):
    h = spark.createDataFrame([("2026-01-01", 24, 10), ("2026-01-02", 24, 30), ("2026-01-04", 20, 40), ("2026-01-05", 24, 50)], "day string, hours_present bigint, events bigint").selectExpr("cast(day as date) day", "hours_present", "events")
    assert tuple(recon.history_volume(h).first()) == (10, 40, 50, 1)
    s = recon.history_status(h, "2026-01-07").first()
    assert (s.stalled, s.holed, s.healthy, s.partial_days, s.missing_days, str(s.expected_latest)) == (False, True, False, 1, 1, "2026-01-05")
    none = recon.history_status(h.where("false"), "2026-01-07").first()
    assert none.empty and none.stalled and not none.holed


def test_capture_rate_is_none_where_it_cannot_be_told(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    assert recon.capture_overlap(ids("a", "a", "b"), ids("a", "c")).first().capture_rate == 0.5
    assert recon.capture_overlap(ids("x"), ids("a")).first().capture_rate is None
    assert recon.capture_overlap(ids("x"), ids()).first().capture_rate == 0.0


def test_repair_of_an_unclaimed_hour_raises(spark):
    claims = spark.createDataFrame([("2026-01-01", 0, 5)], "day string, hour int, events bigint")
    again = spark.createDataFrame([("2026-01-01", 1, "ingested", 5)], "day string, hour int, status string, events bigint")
    with pytest.raises(PySparkException, match="never claimed"):
        recon.reconcile_repairs(claims, again).collect()


def test_a_failing_assertion_stops_and_a_warning_does_not(spark):
    some, none = spark.range(3), spark.range(0)
    assert quality.enforce([Check("a", lambda: none), Check("b", lambda: some, warn=True)]) == [("a", "ok"), ("b", "warn")]
    with pytest.raises(AssertionFailed, match="c:"):
        quality.enforce([Check("c", lambda: some)])


@pytest.mark.parametrize("sql", ["select * from restricted.actor_daily", "select actor_login from x", "select 1 from `restricted` . t", "select * from public.events"])
def test_restricted_data_is_never_published(sql):
    with pytest.raises(panels.NotPublishable):
        panels.guard(sql)
    assert panels.guard("select day from marts.repo_daily -- restricted.x") and True

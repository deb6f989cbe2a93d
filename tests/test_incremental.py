"""Bitmaps that merge, marts kept up day by day, ranks in many tasks, and copies found by a bitmap."""

import random
import re
from datetime import date, datetime, timedelta
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from eventpulse.operators import distinct, marts, ranking, staging
from eventpulse.plans import incremental
from eventpulse.sources import files, lake

DAY = date(2026, 7, 1)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def event(rng, i, day, hour, actor=None, repo=None):
    actor, repo = actor or rng.randrange(1, 9), repo or rng.randrange(1, 6)
    at = datetime.combine(day, datetime.min.time()) + timedelta(hours=hour, seconds=rng.randrange(3600))
    return (str(i), rng.choice(["PushEvent", "WatchEvent"]), f'{{"id":{actor},"login":"u{actor}"}}', f'{{"id":{repo},"name":"o/r{repo}"}}', None, "{}", True, at, day, hour)


ARROW = pa.schema([("id", pa.string()), ("type", pa.string()), ("actor", pa.string()), ("repo", pa.string()), ("org", pa.string()), ("payload", pa.string()), ("public", pa.bool_()), ("created_at", pa.timestamp("us", "UTC")), ("dt", pa.date32()), ("hr", pa.int64())])


def put_hour(spark, root, day, hour, rows):
    folder = Path(lake.partition_dir(root, str(day), hour))
    folder.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table([pa.array(c, t) for c, t in zip(zip(*rows), ARROW.types)] if rows else [pa.array([], t) for t in ARROW.types], schema=ARROW), folder / "events.parquet")


# ranks


@pytest.mark.parametrize("groups", [1, 3, 500])
def test_running_sums_and_ranks_as_plain_ones(spark, groups):
    rng = random.Random(groups)
    rows = [(rng.choice([None, *range(groups)]), rng.randrange(50), i, rng.randrange(9)) for i in range(2000)]
    frame = spark.createDataFrame(rows, "g int, a int, id int, n int")
    got = ranking.running(frame, ["g"], [F.desc("a"), "id"], {"rank": F.lit(1), "total": F.col("n")}).collect()
    want, seen = {}, {}
    for g, a, i, n in sorted(rows, key=lambda r: (-r[1], r[2])):
        nth, total = seen.get(g, (0, 0))
        seen[g] = want[i] = (nth + 1, total + n)
    assert {r.id: (r["rank"], r.total) for r in got} == want and len(got) == 2000
    with pytest.raises(ValueError, match="names used here"):
        ranking.ranked(frame, ["g"], ["a"], "n")


def test_one_day_of_all_rows_is_ranked_in_many_tasks(spark):
    repos = spark.range(4000).select(F.lit(DAY).alias("day"), F.col("id").alias("repo_id"), F.lit("r").alias("repo_name"), (F.col("id") % 97 + 5).alias("actors"), F.lit(200).cast("bigint").alias("events"))
    repos = repos.union(repos.select(F.date_sub("day", 1), "repo_id", "repo_name", (F.col("repo_id") % 11 + 5), "events"))
    eco = spark.createDataFrame([(DAY, 24), (DAY - timedelta(days=1), 24)], "day date, hours_present bigint")
    got = marts.repo_trending(repos, eco)
    shown = plan(got)
    # the only window over a day as a whole has a row for each range, not for each repository
    assert re.findall(r"windowspecdefinition\((\w+)#\d+L?, (\w+)#", shown) == [("_dealt_part", "day"), ("day", "_dealt_part")]
    rows = sorted(got.collect(), key=lambda r: r.rank_in_day)
    assert [r.rank_in_day for r in rows] == list(range(1, 4001))
    assert [r.repo_id for r in rows] == [r.repo_id for r in sorted(rows, key=lambda r: (-r.actors_change, -r.actors, r.repo_id))]


# copies


@pytest.mark.parametrize("slots", [64, 1024, staging.SLOTS])
def test_copies_go_whatever_shares_their_slot(spark, slots):
    """With 64 slots nearly every row is taken for a copy, and the result is the same."""
    rng = random.Random(1)
    rows = [(None if rng.random() < 0.02 else str(rng.randrange(600)), rng.choice([None, rng.randrange(5)]), i) for i in range(900)]
    frame = spark.createDataFrame(rows, "id string, at int, nth int")
    order = F.struct(F.col("at").isNull().alias("undated"), "at", "nth")
    got = {(r.id, r.nth) for r in staging.first_of_each(frame, ["id"], order, slots).collect()}
    best = {}
    for i, at, nth in rows:
        best[i] = min(best.get(i, (2, 0, 0)), (at is None, at or 0, nth))
    assert got == {(i, b[2]) for i, b in best.items()}


def test_rows_without_copies_are_not_shuffled(spark):
    rows = spark.range(3000).select(F.col("id").cast("string").alias("id"), F.lit("x" * 300).alias("much"))
    rows = rows.union(rows.where("id % 100 = 7"))
    path = files.shared_dir(spark)
    rows.write.parquet(path)
    frame = staging.first_of_each(spark.read.parquet(path), ["id"], F.struct("much"))
    assert frame.count() == 3000
    shown = plan(frame)
    union = shown[shown.index("Union") :].split("\n")
    first = [line for line in union[1:] if "HashAggregate" in line or "Exchange" in line][0]
    assert "Broadcast" in first  # the first branch reaches its scan through a broadcast alone


# distinct counts


def test_bitmaps_count_as_distinct_does_and_a_day_reads_itself_only(spark, tmp_path):
    rng, root = random.Random(4), str(tmp_path / "lake")
    days = [DAY + timedelta(days=k) for k in range(3)]
    kept = {d: [event(rng, f"{d}-{i}", d, i % 5, actor=10**9 * rng.randrange(1, 40)) for i in range(60)] for d in days}
    for d, rows in kept.items():
        for h in range(5):
            put_hour(spark, root, d, h, [r for r in rows if r[9] == h])
    store = distinct.DistinctStore(spark, str(tmp_path / "store"))
    of = lambda d: staging.staged(lake.read_lake(spark, root).where(F.col("dt") == F.lit(d)), False).withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
    for d in days:
        store.add(of(d))
        for h in range(5):  # a day that was added is read no more
            (tmp_path / "lake" / f"dt={d}" / f"hr={h}" / "events.parquet").write_bytes(b"not parquet")
    store_rows = [r for rows in kept.values() for r in rows]
    o = store.overview().first()
    assert (o.events, o.days, o.hours, o.repos, o.actors, o.types) == (180, 3, 15, len({r[3] for r in store_rows}), len({r[2] for r in store_rows}), 2)
    part = store.overview(str(days[0]), str(days[1])).first()
    assert (part.events, part.actors) == (120, len({r[2] for d in days[:2] for r in kept[d]}))
    eco = {r.day: (r.events, r.repos, r.actors, r.hours_present) for r in store.ecosystem_daily().collect()}
    assert eco == {d: (60, len({r[3] for r in rows}), len({r[2] for r in rows}), 5) for d, rows in kept.items()}
    assert "Expand" not in plan(store.ecosystem_daily()) + plan(store.overview())
    numbers = store.dictionary().groupBy("kind").agg(F.max("number").alias("most"), F.countDistinct("number").alias("n"), F.countDistinct("value").alias("values")).collect()
    assert all(r.most == r.n == r["values"] for r in numbers)  # dense, and each value once
    again = kept[days[1]][:7]
    for h in range(5):
        put_hour(spark, root, days[1], h, [r for r in again if r[9] == h])
    store.add(of(days[1]))  # replaced, not added to
    assert {r.day: r.events for r in store.ecosystem_daily().collect()} == {days[0]: 60, days[1]: 7, days[2]: 60}


def test_adding_works_out_each_event_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def once(name):
        seen.add(1)
        return name

    rng = random.Random(8)
    rows = [event(rng, i, DAY, i % 4) for i in range(40)]
    frame = spark.createDataFrame([(r[1], r[7], r[8], r[9]) for r in rows], "event_type string, created_at timestamp_ntz, archive_day date, archive_hour long")
    stg = frame.select("*", F.lit(1).cast("long").alias("repo_id"), F.lit(2).cast("long").alias("actor_id"), F.udf(once)(F.lit("o/r")).alias("repo_name"), F.lit("u").alias("actor_login"))
    store = distinct.DistinctStore(spark, str(tmp_path / "store"))
    store.add(stg)
    assert seen.value == 40 and tuple(store.overview().first()) == (40, 1, 4, 1, 1, 2)


def test_an_empty_store(spark, tmp_path):
    store = distinct.DistinctStore(spark, str(tmp_path / "none"))
    assert tuple(store.overview().first()) == (0, 0, 0, 0, 0, 0) and store.ecosystem_daily().count() == 0


# incremental marts


def full(spark, root, mart):
    rows = lake.read_lake(spark, root).withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
    stg = staging.stg_events(rows, payload=False)
    eco, repo = marts.ecosystem_daily(stg), marts.repo_daily(stg)
    return {"ecosystem_daily": eco, "repo_daily": repo, "actor_daily": marts.actor_daily(stg), "repo_trending": marts.repo_trending(repo, eco, 1)}[mart]


def test_only_what_changed_is_built_again_and_equals_a_full_build(spark, tmp_path):
    rng, root, base = random.Random(6), str(tmp_path / "lake"), str(tmp_path / "marts")
    days = [DAY + timedelta(days=k) for k in range(5)]
    hours = {(d, h): [event(rng, f"{d}-{h}-{i}", d, h) for i in range(3)] for d in days for h in range(24)}
    early = hours[days[1], 3][0]
    copy = (early[0], *early[1:7], datetime.combine(days[4], datetime.min.time()) + timedelta(hours=9), days[4], 9)
    hours[days[4], 9].append(copy)  # an id with copies on two days
    for (d, h), rows in hours.items():
        put_hour(spark, root, d, h, rows)

    def same():
        for mart in incremental.SCHEMAS:
            a, b = incremental.read(spark, base, mart), full(spark, root, mart)
            assert sorted(map(str, a.select(*sorted(a.columns)).collect())) == sorted(map(str, b.select(*sorted(a.columns)).collect())), mart

    def written(mart):
        return {p.name: {f.name for f in p.glob("*.parquet")} for p in (tmp_path / "marts" / mart).glob("day=*")}

    name = lambda d: f"day={d}"
    done = incremental.converge(spark, root, base, 1)
    assert done.rebuilt == [str(d) for d in days] and incremental.converge(spark, root, base, 1) == incremental.Pass([], [], [], [])
    before = {m: written(m) for m in incremental.SCHEMAS}
    put_hour(spark, root, days[2], 7, [event(rng, f"new-{i}", days[2], 7, repo=77) for i in range(9)])
    done = incremental.converge(spark, root, base, 1)
    assert (done.changed, done.rebuilt, done.ranked) == ([str(days[2])], [str(days[2])], [str(days[2]), str(days[3])])
    after = {m: written(m) for m in incremental.SCHEMAS}
    touched = {m: {d for d in after[m] if after[m][d] != before[m].get(d)} for m in after}
    assert touched["repo_daily"] == {name(days[2])} and touched["repo_trending"] == {name(days[2]), name(days[3])}
    same()
    # The earlier copy goes: the later one, of a day that didn't change, counts now.
    put_hour(spark, root, days[1], 3, hours[days[1], 3][1:])
    done = incremental.converge(spark, root, base, 1)
    assert done.changed == [str(days[1])] and done.rebuilt == [str(days[1]), str(days[4])]
    same()
    lake.drop_day(spark, root, str(days[3]))
    done = incremental.converge(spark, root, base, 1)
    assert done.gone == [str(days[3])] and name(days[3]) not in written("repo_daily") and name(days[4]) not in written("repo_trending")
    same()
    # What a check refuses isn't published, and is tried again.
    put_hour(spark, root, days[0], 5, [(f"late-{r[0]}", *r[1:9], 5) for r in hours[days[0], 4]])
    was = written("repo_daily")
    for _ in range(2):
        with pytest.raises(Exception, match="partition"):
            incremental.converge(spark, root, base, 1)
    assert written("repo_daily") == was

"""Buckets, guarded panels, footers, and a ledger in a database."""

import re
from datetime import date, datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from eventpulse.operators import ledger, marts, panels, recon
from eventpulse.plans import build
from eventpulse.sources import lake
from tests.test_incremental import ARROW, DAY, event, plan, put_hour


def test_a_join_of_bucketed_marts_has_no_shuffle(spark):
    """The ranking over a published mart: both sides of the join come from buckets of repo_id as they are."""
    spark.sql("create database if not exists marts")
    rows = spark.range(1500).select(F.date_add(F.lit(DAY), (F.col("id") % 3).cast("int")).alias("day"), (F.col("id") % 500).alias("repo_id"), F.lit("r").alias("repo_name"), F.lit(9).cast("bigint").alias("events"), (F.col("id") % 7 + 1).alias("actors"))
    rows.repartition(build.BUCKETS, "repo_id").write.mode("overwrite").bucketBy(build.BUCKETS, "repo_id").sortBy("repo_id").saveAsTable("marts.bucketed")
    repos = spark.table("marts.bucketed")
    prior = repos.select(F.col("repo_id").alias("_repo"), F.date_add("day", 1).alias("_day"), F.col("actors").alias("before"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = repos.join(prior, (F.col("repo_id") == F.col("_repo")) & (F.col("day") == F.col("_day")), "left")
        shown = plan(joined)
        assert "SortMergeJoin" in shown and "Exchange" not in shown
        assert joined.count() == 1500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table marts.bucketed")


def test_marts_have_the_columns_that_they_may_have(spark, tmp_path, monkeypatch):
    for h in range(2):
        put_hour(spark, str(tmp_path), DAY, h, [(f"{h}", "PushEvent", '{"id":1,"login":"u"}', '{"id":2,"name":"o/r"}', None, "{}", True, datetime(2026, 7, 1, h), DAY, h)])
    real = marts.repo_daily
    monkeypatch.setattr(marts, "repo_daily", lambda stg: real(stg).withColumn("actor_login", F.lit("u")))
    with pytest.raises(build.ColumnsDiffer, match="repo_daily"):
        build.build(spark, lake.read_lake(spark, str(tmp_path)).withColumn("created_at", F.col("created_at").cast("timestamp_ntz")))


def test_panels_are_guarded_by_what_their_plan_reads(spark):
    spark.sql("create database if not exists restricted")
    spark.createDataFrame([(DAY, 1, "u", 3)], "day date, actor_id bigint, actor_login string, events bigint").write.mode("overwrite").saveAsTable("restricted.accounts")
    accounts = spark.table("restricted.accounts")
    try:
        assert panels.relations(accounts) == ["restricted.accounts"]
        with pytest.raises(panels.NotPublishable, match="restricted.accounts"):
            panels.publish("select count(*) as n from {x}", x=accounts)
        trending = accounts.select("day", F.lit(1).alias("actors_change"), F.lit(True).alias("absent_prior_day"))
        for run in (panels.largest_gain, panels.ranked_latest, panels.first_appearances):
            with pytest.raises(panels.NotPublishable, match="restricted.accounts"):
                run(trending)
        with pytest.raises(panels.NotPublishable, match="actor_login"):
            panels.publish("select * from {x}", x=spark.createDataFrame([("u", 1)], "actor_login string, n int"))
    finally:
        spark.sql("drop table restricted.accounts")


def test_hours_are_counted_from_footers(spark, tmp_path):
    import random

    rng, root = random.Random(2), str(tmp_path / "lake")
    for h, n in ((0, 5), (1, 3), (2, 0)):
        put_hour(spark, root, DAY, h, [event(rng, f"{h}-{k}", DAY, h) for k in range(n)])
    put_hour(spark, root, DAY, 5, [event(rng, f"x-{k}", DAY, 6) for k in range(4)])  # a file that holds another hour
    put_hour(spark, root, DAY, 7, [event(rng, f"y-{k}", DAY, 7 + k % 2) for k in range(6)])  # and one that holds two
    counts = lake.counts_by_hour(spark, root)
    assert {(r.hour, r.n) for r in counts.collect()} == {(0, 5), (1, 3), (6, 4), (7, 3), (8, 3)}
    for h in (0, 1, 5):  # without their pages, footers are all there is to read
        path = tmp_path / "lake" / f"dt={DAY}" / f"hr={h}" / "events.parquet"
        data, size = path.read_bytes(), pq.read_metadata(path).serialized_size + 8
        path.write_bytes(b"PAR1" + b"\0" * (len(data) - size - 4) + data[-size:])
    told = {r.path.split("hr=")[1].split("/")[0]: (r.rows, r.hour, r.last_hour) for r in lake.footers(spark, [p for _, _, p, _ in lake.lake_files(spark, root)]).collect()}
    assert told["5"] == (4, 6, 6) and told["7"] == (6, 7, 8) and told["0"] == (5, 0, 0) and told["2"][0] == 0
    assert {(r.hour, r.n) for r in lake.counts_by_hour(spark, root).collect()} == {(0, 5), (1, 3), (6, 4), (7, 3), (8, 3)}
    claims = spark.createDataFrame([(DAY, 0, 5, None), (DAY, 5, 4, None)], "day date, hour int, events bigint, bytes bigint")
    found = {(r.hour, r.problem) for r in recon.verify(claims, lake.lake_files_frame(spark, root), lake.counts_by_hour(spark, root)).collect()}
    assert (5, "count") in found and not any(h == 0 for h, _ in found)
    bare = tmp_path / "bare.parquet"  # without statistics a file is scanned
    pq.write_table(pa.table([pa.array([x], t) for x, t in zip(event(rng, "z", DAY, 9), ARROW.types)], schema=ARROW), bare, write_statistics=False)
    assert lake.footers(spark, [str(bare)]).first().day is None


def test_a_ledger_in_a_database_is_filtered_there(spark, tmp_path):
    url, driver = f"jdbc:derby:{tmp_path / 'db'};create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    days = [date(2026, 7, d) for d in range(1, 11)]
    rows = [(d, h, "ingested" if h % 3 else "missing", 10 * h if h % 3 else None, 1000, "told", datetime(2026, 7, 12)) for d in days for h in range(24)]
    kept = spark.createDataFrame(rows, ledger.SCHEMA)
    kept.write.format("jdbc").options(url=url, dbtable="ledger", driver=driver, createTableColumnTypes="status varchar(20), detail varchar(200)").save()
    held = ledger.jdbc_ledger(spark, url, "ledger", "2026-07-03", "2026-07-06", 4, driver=driver)
    assert held.rdd.getNumPartitions() == 4
    assert sorted(map(str, held.select(*kept.columns).collect())) == sorted(map(str, kept.where("day between date '2026-07-03' and date '2026-07-06'").collect()))
    claims = ledger.ingested_hours(held)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    pushed = re.search(r"PushedFilters: \[(.*?)\]\s*,\s*ReadSchema: (\S+)", plan(claims).replace("*", ""))
    assert pushed and "EqualTo(" in pushed[1] and "ingested" in pushed[1] and "GreaterThanOrEqual(" in pushed[1] and "recorded_at" not in pushed[2].lower()
    files = spark.createDataFrame([(days[2], 1, 1000), (days[2], 2, 7), (days[3], 23, 1000)], "day date, hour int, bytes bigint")
    same = lambda c: sorted(map(str, recon.verify(c, files).collect()))
    assert same(claims) == same(ledger.ingested_hours(kept.where("day between date '2026-07-03' and date '2026-07-06'")))

"""Files, the convergence loop, commands, the build, and the live path."""

import gzip
import json
from collections import Counter
import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventpulse import cli
from eventpulse.operators.ledger import LedgerTable
from eventpulse.operators.quality import AssertionFailed
from eventpulse.plans import build, converge
from eventpulse.sources import lake
from eventpulse.streaming import live, wire

DAY = "2026-07-22"


def write_hour(folder, hour, n=3, day=DAY, at=None, **more):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / lake.hour_filename(day, hour)
    with gzip.open(path, "wt") as f:
        for i in range(n):
            e = {"id": f"{hour}-{i}", "type": "PushEvent", "actor": {"id": i, "login": f"u{i}"}, "repo": {"id": 2, "name": "o/hello"}, "org": None, "payload": {"size": 1.0, "z": "a b", "a": 12345678901234567890}, "public": True, "created_at": at or f"{day}T{hour:02}:00:0{i % 10}Z", "extra": 1}
            f.write(json.dumps(e | more, ensure_ascii=False) + "\n")
    return str(path)


def test_an_hour_becomes_one_proven_file(spark, tmp_path):
    root = str(tmp_path / "lake")
    path = write_hour(tmp_path / "a", 0)
    w = lake.write_hour(spark, path, root, DAY, 0)
    assert w.events == 3 and w.path.endswith(f"dt={DAY}/hr=0/events.parquet") and not list((tmp_path / "lake").glob("_staging/*"))
    row = lake.read_lake(spark, root).where("id = '0-1'").first()
    assert row.payload == '{"size": 1.0, "z": "a b", "a": 12345678901234567890}' and (str(row.dt), row.hr) == (DAY, 0)
    assert lake.write_hour(spark, path, root, DAY, 0).events == 3 and lake.read_lake(spark, root).count() == 3
    assert lake.present_hours(spark, root, DAY) == [0] and lake.counts_by_hour(spark, root).first().n == 3
    assert lake.write_hour(spark, write_hour(tmp_path / "e", 1, 0), root, DAY, 1).events == 0
    assert lake.read_lake(spark, str(tmp_path / "none")).count() == 0 and lake.lake_files(spark, str(tmp_path / "none")) == []


@pytest.mark.parametrize("bad", [{"at": f"{DAY}T06:00:00Z"}, {"created_at": None}])
def test_a_wrong_hour_is_refused_and_leaves_nothing(spark, tmp_path, bad):
    path = write_hour(tmp_path / "a", 5, **bad)
    with pytest.raises(lake.PartitionMismatch):
        lake.write_hour(spark, path, str(tmp_path / "lake"), DAY, 5)
    assert not list((tmp_path / "lake").rglob("events.parquet"))


def test_a_malformed_line_fails(spark, tmp_path):
    path = tmp_path / f"{DAY}-3.json"
    path.write_text('{"id": "1"}\nnot json\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        lake.read_archive(spark, str(path)).collect()


def test_a_day_is_aggregated_again_and_released(spark, tmp_path):
    root, out = str(tmp_path / "lake"), str(tmp_path / "agg")
    for h in (0, 1):
        lake.write_hour(spark, write_hour(tmp_path / "a", h, 12), root, DAY, h)
    for _ in range(2):
        report = lake.aggregate_day(spark, root, out, DAY)
    assert not report.complete and (report.hours_present, report.repos) == (2, 1)
    row = spark.read.parquet(f"{out}/repo/dt={DAY}/repo_daily.parquet").first()
    assert (row.events, row.min_events, row.repo_name) == (24, 20, "o/hello") and "payload" not in row and "actor_login" not in row
    assert lake.aggregate_day(spark, root, out, DAY, release=True).dropped == 2 and not (tmp_path / "lake" / f"dt={DAY}").exists()
    assert lake.read_history(spark, out, "ecosystem", "day date").count() == 1 and lake.read_history(spark, out, "none", "day date").count() == 0
    with pytest.raises(FileNotFoundError):
        lake.aggregate_day(spark, root, out, DAY)


def test_convergence_records_every_state(spark, tmp_path):
    table, root = LedgerTable(spark, str(tmp_path / "ledger")), str(tmp_path / "lake")
    for h in (0, 1):
        write_hour(tmp_path / "pub", h)
    (tmp_path / "pub" / lake.hour_filename(DAY, 2)).write_bytes(b"no gzip")
    write_hour(tmp_path / "pub", 3, at=f"{DAY}T09:00:00Z")
    fetch = converge.folder_publisher(str(tmp_path / "pub"))
    go = lambda now: converge.converge_once(spark, table, fetch, str(tmp_path / "archive"), root, DAY, DAY, datetime.fromisoformat(now))
    got = {r.hour: r.status for r in go(f"{DAY}T05:30:00")}
    assert got == {0: "ingested", 1: "ingested", 2: "failed", 3: "failed", 4: None}
    assert {r.hour: r.status for r in go("2026-07-23T05:00:00")}[4] == "missing"
    assert 4 not in {r.hour for r in go("2026-07-23T05:00:00")}
    args = ["--lake", root, "--ledger", str(tmp_path / "ledger")]
    assert cli.main(["verify", *args, "--count-rows"], spark) == 0
    (tmp_path / "lake" / f"dt={DAY}" / "hr=1" / "events.parquet").unlink()
    assert cli.main(["verify", *args], spark) == 3
    more = [*args, "--archive", str(tmp_path / "archive"), "--publisher", str(tmp_path / "pub")]
    assert cli.main(["repair-lake", *more, "--dry-run"], spark) == 3 and cli.main(["repair-lake", *more], spark) == 0 and cli.main(["verify", *args], spark) == 0
    with pytest.raises(ValueError, match="refused"):
        table.record((datetime(2026, 7, 22).date(), 99, "missing", None, None, None, None))
    stop = threading.Event()
    clock = lambda: stop.set() or datetime.fromisoformat("2026-07-22T00:30:00")
    assert converge.converge_forever(spark, table, fetch, str(tmp_path / "archive"), root, stop, clock, lookback=0, seconds=0) == 1


def test_commands_and_their_codes(spark, tmp_path, capsys):
    path = write_hour(tmp_path / "a", 0)
    assert cli.main(["explore", path], spark) == 0 and '"TOTAL", "n": 3' in capsys.readouterr().out
    assert cli.main(["capture-rate", path, path], spark) == 0
    assert cli.main(["capture-rate", path, write_hour(tmp_path / "b", 1)], spark) == 1
    assert cli.main(["backfill", "2026-02-02", "2026-02-01", "--lake", "x", "--ledger", "x", "--archive", "x", "--publisher", "x"], spark) == 2
    assert cli.main(["aggregate", DAY, "--lake", str(tmp_path / "no"), "--aggregates", "x"], spark) == 1 and capsys.readouterr().err.count("\n") >= 1
    assert cli.main(["history-status", "--aggregates", str(tmp_path / "no")], spark) == 3
    with pytest.raises(SystemExit):
        cli.main(["unheard-of"], spark)


def test_marts_are_built_and_published_only_if_sound(spark, tmp_path):
    root = str(tmp_path / "lake")
    for h in range(2):
        lake.write_hour(spark, write_hour(tmp_path / "a", h), root, DAY, h)
    rows = lake.read_lake(spark, root)
    assert cli.main(["marts-status", "--lake", root], spark) == 3
    assert all(r == "ok" for _, r in build.build(spark, rows))
    assert cli.main(["marts-status", "--lake", root], spark) == 0 and spark.table("marts.repo_daily").count() == 1
    bad = rows.withColumn("hr", F.lit(7).cast("bigint"))
    with pytest.raises(AssertionFailed, match="partition"):
        build.build(spark, bad)
    assert spark.table("marts.ecosystem_daily").first().hours_present == 2


def message(**more):
    event = {"id": "1", "type": "PushEvent", "actor": {"id": 1, "login": "u", "x": 1}, "repo": {"id": 2, "name": "o/r"}, "payload": {"b": 1.0, "a": 2}, "public": True, "created_at": "2026-07-22T05:00:00+02:00"}
    return json.dumps({"v": 1, "captured_at": "2026-07-22T05:00:01Z", "event": event | more}).encode()


def test_triage_in_order(spark):
    cases = [(message(), None), (b"", "corrupt"), (None, "corrupt"), (b"{", "corrupt"), (b"\xff\xfe", "corrupt"), (b"[1]", "unsupported_version"), (b"7", "unsupported_version"), (b'{"v":99}', "unsupported_version"), (b'{"v":"1"}', "unsupported_version"), (b"{}", "unsupported_version"),
             (b'{"v":1}', "invalid_shape"), (message(repo=None), "invalid_shape"), (message(created_at="2026-07-22T05:00:00"), "invalid_shape"), (message(id=None), "invalid_shape"), (message(created_at="2026-99-22T05:00:00Z"), "invalid_shape")]
    rows = spark.createDataFrame([(i, bytearray(b"k"), None if v is None else bytearray(v)) for i, (v, _) in enumerate(cases)], "i int, key binary, value binary")
    told = wire.triage(rows)
    assert [r.reason for r in told.orderBy("i").collect()] == [want for _, want in cases]
    stored = wire.store_rows(told.where("reason is null")).first()
    assert stored.payload == '{"b":1.0,"a":2}' and stored.created_at == datetime(2026, 7, 22, 3) and stored.captured_at == datetime(2026, 7, 22, 5, 0, 1)
    back = wire.decode_dead_letters(wire.dead_letters(told.where("i = 4"))).first()
    assert (back.reason, bytes(back.key), bytes(back.value)) == ("corrupt", b"k", b"\xff\xfe")


def test_a_message_is_parsed_once(spark):
    """Whatever is asked of a triaged message, its plan parses it in one place, and a sent one is written in one."""
    rows = spark.createDataFrame([(None, bytearray(message()))], "key binary, value binary")
    for asked in (wire.store_rows(wire.triage(rows).where("reason is null")).select("created_at"), wire.dead_letters(wire.triage(rows).where("reason is not null"))):
        plan = asked._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1 and plan.count("parseJson(") == 1
    columns = ["cast(id as string) id", "'PushEvent' type", "struct(id, 'u' as login) actor", "struct(id, 'o/r' as name) repo", "'{}' payload", "true public", "'2026-07-22T05:00:00Z' created_at", "'2026-07-22T05:00:01Z' captured_at"]
    sent = wire.encode(spark.range(1).selectExpr(*columns))
    plan = wire.triage(sent).where("reason is null").select("envelope.event.id", "envelope.event.type")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("to_json(") <= 1 and plan.count("from_json(") == 1


def test_consuming_twice_stores_once(spark, tmp_path):
    rows = [(None, bytearray(message(id=str(i % 4)))) for i in range(6)] + [(bytearray(b"k"), bytearray(b"oops")), (None, None)]
    spark.createDataFrame(rows, "key binary, value binary").write.parquet(str(tmp_path / "m"))
    store, totals = live.Store(spark, str(tmp_path / "s")), Counter()
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    for nth in range(2):
        live.consume(live.file_messages(spark, str(tmp_path / "m")), store, str(tmp_path / "d"), str(tmp_path / f"c{nth}"), totals).awaitTermination()
    assert store.read().count() == 4 and live.summary(totals) == {"consumed": 16, "stored": 4, "duplicates": 8, "dead_lettered": 4, "by_reason": {"corrupt": 4}}
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held
    batch = spark.read.parquet(str(tmp_path / "m"))
    for _ in range(2):  # one batch delivered twice
        live.consume_batch(batch, store, str(tmp_path / "once"))
    assert spark.read.parquet(str(tmp_path / "once")).count() == 2
    assert spark.read.parquet(str(tmp_path / "d")).count() == 4


def test_counters_are_observed_by_the_writes(spark, tmp_path):
    """A batch is triaged once; no job gathers or counts, and a batch that is delivered again tells the same but for what is stored."""
    rows = [(None, bytearray(message(id=str(i % 4)))) for i in range(6)] + [(bytearray(b"k"), bytearray(b"oops")), (None, bytearray(b'{"v":9}')), (None, bytearray(message(repo=None)))]
    spark.createDataFrame(rows, "key binary, value binary").write.parquet(str(tmp_path / "m"))
    batch, store = spark.read.parquet(str(tmp_path / "m")), live.Store(spark, str(tmp_path / "s"))
    dead = {"dead corrupt": 1, "dead unsupported_version": 1, "dead invalid_shape": 1}
    first = live.consume_batch(batch, store, str(tmp_path / "d"))
    assert first == Counter(consumed=9, stored=4) + Counter(dead)
    again = live.consume_batch(batch, store, str(tmp_path / "d"))
    assert again == Counter(consumed=9) + Counter(dead) and live.summary(first + again)["duplicates"] == 8
    assert live.consume_batch(batch.where("false"), store, str(tmp_path / "none")).total() == 0 and not (tmp_path / "none").exists()
    assert store.read().count() == 4 and spark.read.parquet(str(tmp_path / "d")).count() == 3


def test_a_batch_delivered_again_counts_nothing_stored_without_broadcasts(spark, tmp_path):
    """Where the store is too large for a broadcast, no row is left before the write's exchange; the counter is 0, not an error."""
    batch = spark.createDataFrame([(None, bytearray(message(id=str(i)))) for i in range(6)], "key binary, value binary")
    store, before = live.Store(spark, str(tmp_path / "s")), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        told = [live.consume_batch(batch, store, str(tmp_path / "d")) for _ in range(2)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert told == [Counter(consumed=6, stored=6), Counter(consumed=6)] and store.read().count() == 6


def test_pages_split_and_sinks(spark, tmp_path):
    items = [message(id="9").decode()[len('{"v": 1, "captured_at": "2026-07-22T05:00:01Z", "event": ') : -1], '{"id": "1"}', '"text"']
    good, bad = live.split_page(spark.createDataFrame([(x,) for x in items], "value string"))
    assert [r.id for r in good.collect()] == ["9"] and bad.count() == 2
    assert live.write_rejects(bad, str(tmp_path / "r")) == 2 and live.write_rejects(bad.where("false"), str(tmp_path / "none")) == 0 and not (tmp_path / "none").exists()
    rows = spark.createDataFrame([("2026-07-22 05:59:59", "a"), ("2026-07-22 06:00:00", "b")], "created_at string, value string").withColumn("created_at", F.col("created_at").cast("timestamp"))
    live.write_hourly(rows, str(tmp_path / "h"))
    assert sorted(p.name for p in (tmp_path / "h").glob("hour_key=*")) == ["hour_key=2026-07-22-05", "hour_key=2026-07-22-06"]
    seen = []
    missed = live.write_in_order(rows, lambda b: seen.append("first"), lambda b: 1 / 0, lambda b: seen.append("last"))
    assert seen == ["first", "last"] and missed == ["ZeroDivisionError: division by zero"]
    with pytest.raises(ZeroDivisionError):
        live.write_in_order(rows, lambda b: 1 / 0)


def test_window_is_first_in_first_out():
    assert live.admit([], "abacab", 2) == ([True, True, False, True, True, True], ["a", "b"])
    assert live.admit(["a", "b"], "ac", 2) == ([False, True], ["b", "c"])
    with pytest.raises(ValueError):
        live.admit([], "a", 0)


def test_first_of_a_batch(spark):
    rows = spark.createDataFrame([("a", 3, "z"), ("a", 1, "y"), ("b", 2, "x")], "id string, seq int, v string")
    assert sorted(map(tuple, live.dedupe_batch(rows).collect())) == [("a", 1, "y"), ("b", 2, "x")]


def test_exact_deduplication_takes_a_file_a_trigger(spark, tmp_path, monkeypatch):
    """All files in one trigger would put the whole sequence into the task's memory."""
    from eventpulse.plans import catalog

    monkeypatch.setattr(catalog.files, "shared_dir", lambda _: str(tmp_path))
    sf = "/root/testdata/sf0.001"
    ids = {r.id for r in catalog.queries()["stream_fifo_dedup"](spark, sf).collect()}
    assert ids == {r.id for r in catalog.Tables(spark, sf).lake.select("id").distinct().collect()}
    written = len(list((tmp_path / "ids").glob("part-*.parquet")))
    assert written >= 8 and len([p for p in (tmp_path / "checkpoint" / "offsets").iterdir() if p.name.isdigit()]) >= written

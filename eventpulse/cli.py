"""Commands of the engine. Exit codes: 0 fine, 1 error, 2 usage, 3 finished but something is outstanding."""

from __future__ import annotations

import argparse
import json
import os
import signal
import sys
import threading
from collections import Counter
from collections.abc import Sequence
from contextlib import contextmanager
from datetime import UTC, date, datetime

from eventpulse.session import session

OUTSTANDING = 3


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


@contextmanager
def _until_told():
    """An event that interrupt and terminate signals set, for loops that end in order; what the signals did before is put back."""
    told = threading.Event()
    before = {s: signal.signal(s, lambda *_: told.set()) for s in (signal.SIGINT, signal.SIGTERM)}
    try:
        yield told
    finally:
        for s, handler in before.items():
            signal.signal(s, handler)


def _day(text: str) -> str:
    return date.fromisoformat(text).isoformat()


def _publisher(place: str):
    """Archive hours from a folder, or over HTTP."""
    from eventpulse.plans import converge

    return converge.web_publisher(place) if place.startswith(("http://", "https://")) else converge.folder_publisher(place)


def _show(rows) -> None:
    for r in rows:
        print(json.dumps(r if isinstance(r, dict) else r.asDict(), default=str))


def explore(spark, a) -> int:
    from eventpulse.operators import figures
    from eventpulse.sources import lake

    rows = figures.type_histogram(lake.read_ids(spark, a.path)).orderBy("n", "type", ascending=[False, True]).collect()
    _show(rows)
    print(json.dumps({"type": "TOTAL", "n": sum(r.n for r in rows)}))
    return 0


def backfill(spark, a) -> int:
    from eventpulse.operators import ledger
    from eventpulse.plans import converge

    if a.last < a.first:
        print("the last day comes before the first", file=sys.stderr)
        return 2
    table, now = ledger.LedgerTable(spark, a.ledger), _now()
    reports = converge.converge_once(spark, table, _publisher(a.publisher), a.archive, a.lake, a.first, a.last, now, retry_failed=True, concurrency=a.concurrency)
    _show({"day": r.day, "hour": r.hour, "status": r.status, "events": r.events, "detail": r.detail} for r in reports)
    left = ledger.due_hours(ledger.pending_hours(spark, table.read(), a.first, a.last, True), now.isoformat(" ")).count()
    return OUTSTANDING if left else 0


def aggregate(spark, a) -> int:
    from eventpulse.sources import lake

    fetch = None
    if a.publisher:  # hours that the lake lacks are fetched first; an hour that isn't published stays out
        from eventpulse.plans import converge

        def fetch(day: str, hour: int) -> str | None:
            try:
                return _publisher(a.publisher)(day, hour, a.archive)
            except converge.NotPublished:
                return None

    report = lake.aggregate_day(spark, a.lake, a.aggregates, a.day, a.floor, a.release, fetch)
    _show([vars(report) | {"complete": report.complete}])
    return 0 if report.complete else OUTSTANDING


def history_status(spark, a) -> int:
    from eventpulse.functions import show
    from eventpulse.operators import recon
    from eventpulse.sources import lake

    history = lake.read_history(spark, a.aggregates, "ecosystem", "day date, hours_present bigint, events bigint")
    status = recon.history_status(history, a.as_of or str(_now().date()), a.grace).first()
    missing = [r.day for r in recon.missing_days(history).orderBy("day").collect()]
    _show([status, {"missing": show.shortened(missing)}, *recon.history_volume(history).collect()])
    return 0 if status.healthy else OUTSTANDING


def verify(spark, a) -> int:
    from eventpulse.operators import ledger, recon
    from eventpulse.sources import lake

    claims = ledger.ingested_hours(ledger.LedgerTable(spark, a.ledger).read())
    rows = recon.verify(claims, lake.lake_files_frame(spark, a.lake), lake.counts_by_hour(spark, a.lake) if a.count_rows else None).orderBy("day", "hour").collect()
    _show(rows)
    return OUTSTANDING if any(r.problem != "unrecorded" for r in rows) else 0


def repair_lake(spark, a) -> int:
    from eventpulse.operators import ledger
    from eventpulse.plans import converge

    rows = converge.repair(spark, ledger.LedgerTable(spark, a.ledger), _publisher(a.publisher), a.archive, a.lake, _now(), a.dry_run)
    _show(rows)
    return OUTSTANDING if (a.dry_run and rows) or any(r["verdict"] == "NOT RECOVERED" for r in rows) else 0


def build_marts(spark, a) -> int:
    from eventpulse.plans.build import build
    from eventpulse.sources import lake

    _show({"check": n, "result": r} for n, r in build(spark, lake.read_lake(spark, a.lake)))
    return 0


def marts_status(spark, a) -> int:
    from eventpulse.operators import recon
    from eventpulse.sources import lake

    built = spark.table("marts.ecosystem_daily") if spark.catalog.tableExists("marts.ecosystem_daily") else spark.createDataFrame([], "day date, hours_present bigint")
    rows = recon.marts_freshness(lake.hours_by_day(spark, a.lake), built).where("kind <> 'current'").orderBy("day").collect()
    _show(rows)
    return OUTSTANDING if any(r.kind in ("unbuilt", "behind") for r in rows) else 0


def marts_converge(spark, a) -> int:
    """With a folder for marts, build the days that changed and nothing else; otherwise the published tables, if they lag."""
    if not a.marts:
        return build_marts(spark, a) if marts_status(spark, a) == OUTSTANDING else 0
    from eventpulse.plans import incremental

    _show([vars(incremental.converge(spark, a.lake, a.marts))])
    return 0


def capture_rate(spark, a) -> int:
    from eventpulse.operators import recon
    from eventpulse.sources import lake

    row = recon.capture_overlap(lake.read_ids(spark, a.live), lake.read_ids(spark, a.archive)).first()
    _show([row])
    return 1 if row.capture_rate is None else 0


def consume(spark, a) -> int:
    from eventpulse.streaming import live

    messages = live.kafka_messages(spark, a.servers, a.topic) if a.servers else live.file_messages(spark, a.messages)
    totals: Counter = Counter()
    query = live.consume(messages, live.Store(spark, a.store), a.dead_letters, a.checkpoint, totals, available_now=not a.forever)
    with _until_told() as stop:
        while not query.awaitTermination(1):
            if stop.is_set():
                query.stop()
    _show([live.summary(totals)])
    return 0


def poll(spark, a) -> int:
    """Follow a paged feed: valid items by the hour of their event, rejects beside; items seen within an hour come once."""
    from pyspark.sql import functions as F

    from eventpulse.sources import web
    from eventpulse.streaming import live

    totals: Counter = Counter()
    folder = a.folder.rstrip("/")

    def write(batch, _nth: int) -> None:
        good, bad = live.split_page(batch.select("value"))
        live.write_hourly(good.select(F.col("raw").alias("value"), F.col("created_at").cast("timestamp").alias("created_at")), folder)
        totals.update(cycles=1, rejected=live.write_rejects(bad, f"{folder}-rejects"))

    stream = web.register(spark).readStream.format("event_pages").option("url", a.feed).option("pages", a.pages)
    stream = stream.option("token", os.environ["EVENTPULSE_TOKEN"]) if "EVENTPULSE_TOKEN" in os.environ else stream
    items = stream.load().withColumn("id", F.coalesce(F.get_json_object("value", "$.id"), F.sha2("value", 256)))
    items = items.withColumn("seen_at", F.coalesce(F.try_to_timestamp(F.get_json_object("value", "$.created_at")), F.current_timestamp()))
    query = live.watermark_dedup(items, "1 hour", "id", "seen_at").writeStream.foreachBatch(write).option("checkpointLocation", a.checkpoint).trigger(processingTime=f"{a.interval} seconds").start()
    with _until_told() as told:
        while not query.awaitTermination(0.2):
            if told.is_set() or (a.cycles and totals["cycles"] >= a.cycles):
                query.stop()
    _show([dict(totals)])
    return 0


def fetch_archive(spark, a) -> int:
    print(_publisher(a.publisher)(a.day, a.hour, a.archive))
    return 0


def archive_serve(spark, a) -> int:
    from eventpulse.operators import ledger
    from eventpulse.plans import converge

    with _until_told() as stop:
        passes = converge.converge_forever(spark, ledger.LedgerTable(spark, a.ledger), _publisher(a.publisher), a.archive, a.lake, stop, _now, a.lookback, a.seconds, a.passes, not a.discard_source)
    _show([{"passes": passes}])
    return 0


def figures_page(spark, a) -> int:
    from eventpulse.operators import site
    from eventpulse.sources import files, lake

    held = lake.lake_files(spark, a.lake)
    text = site.render(site.gather(lake.read_lake(spark, a.lake), a.held_out, sum(f[3] for f in held), len(held), a.busy))
    files.write_text(spark, a.out, text)
    _show([{"page": a.out, "bytes": len(text.encode())}])
    return 0


_LAKE, _LEDGER, _DAYS = ["--lake"], ["--ledger"], ["first", "last"]
COMMANDS = {
    "explore": (explore, ["path"]),
    "backfill": (backfill, [*_DAYS, *_LAKE, *_LEDGER, "--archive", "--publisher"]),
    "aggregate": (aggregate, ["day", *_LAKE, "--aggregates"]),
    "history-status": (history_status, ["--aggregates"]),
    "verify": (verify, [*_LAKE, *_LEDGER]),
    "repair-lake": (repair_lake, [*_LAKE, *_LEDGER, "--archive", "--publisher"]),
    "build-marts": (build_marts, _LAKE),
    "marts-status": (marts_status, _LAKE),
    "marts-converge": (marts_converge, _LAKE),
    "capture-rate": (capture_rate, ["live", "archive"]),
    "consume": (consume, ["--store", "--dead-letters", "--checkpoint"]),
    "poll": (poll, ["--feed", "--folder", "--checkpoint"]),
    "fetch-archive": (fetch_archive, ["day", "--publisher", "--archive"]),
    "archive-serve": (archive_serve, [*_LAKE, *_LEDGER, "--archive", "--publisher"]),
    "figures-page": (figures_page, [*_LAKE, "--held-out", "--out"]),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="eventpulse")
    subs = top.add_subparsers(dest="command", required=True)
    for name, (_, args) in COMMANDS.items():
        p = subs.add_parser(name)
        for x in args:
            p.add_argument(x, **({"required": True} if x.startswith("--") else {}), type=_day if x in ("first", "last", "day") else str)
        if name == "backfill":
            p.add_argument("--concurrency", type=int, default=3)
        if name == "aggregate":
            p.add_argument("--floor", type=int, default=20)
            p.add_argument("--release", action="store_true")
            p.add_argument("--publisher")
            p.add_argument("--archive", default=".")
        if name == "poll":
            p.add_argument("--cycles", type=int)
            p.add_argument("--interval", type=float, default=10.0)
            p.add_argument("--pages", type=int, default=3)
        if name == "fetch-archive":
            p.add_argument("hour", type=int, choices=range(24))
        if name == "marts-converge":
            p.add_argument("--marts")
        if name == "archive-serve":
            p.add_argument("--lookback", type=int, default=3)
            p.add_argument("--seconds", type=float, default=900.0)
            p.add_argument("--passes", type=int)
            p.add_argument("--discard-source", action="store_true")
        if name == "figures-page":
            p.add_argument("--busy", type=int, default=20)
        if name == "history-status":
            p.add_argument("--as-of", type=_day)
            p.add_argument("--grace", type=int, default=1)
        if name == "verify":
            p.add_argument("--count-rows", action="store_true")
        if name == "repair-lake":
            p.add_argument("--dry-run", action="store_true")
        if name == "consume":
            p.add_argument("--messages")
            p.add_argument("--servers")
            p.add_argument("--topic", default="events")
            p.add_argument("--forever", action="store_true")
    return top


def main(argv: Sequence[str] | None = None, spark=None) -> int:
    args = parser().parse_args(argv)
    try:
        return COMMANDS[args.command][0](spark or session(), args)
    except Exception as e:  # one line for the operator
        print(f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())

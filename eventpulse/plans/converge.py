"""Bringing the lake up to the calendar: fetch, convert and record each due hour, several at a time, again and again."""

from __future__ import annotations

import logging
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import SparkSession

from eventpulse.operators import ledger
from eventpulse.operators.ledger import FAILED, INGESTED, MISSING, LedgerTable
from eventpulse.sources import files, lake, web

log = logging.getLogger(__name__)
GRACE = timedelta(hours=24)
CONCURRENCY, SCAN_SECONDS, LOOKBACK_DAYS = 3, 900, 3


class NotPublished(Exception):
    """The publisher answers that there is no such hour."""


def hour_end(day: str, hour: int) -> datetime:
    return datetime.combine(date.fromisoformat(day), datetime.min.time()) + timedelta(hours=hour + 1)


def folder_publisher(folder: str) -> Callable[[str, int, str], str]:
    """A publisher that is a folder of any file system: an hour is copied into ``dest`` beside and then renamed; what is there already is kept."""

    def fetch(day: str, hour: int, dest: str) -> str:
        spark, name = SparkSession.builder.getOrCreate(), lake.hour_filename(day, hour)
        final, source = f"{dest.rstrip('/')}/{name}", f"{folder.rstrip('/')}/{name}"
        if not files.exists(spark, final):
            if not files.exists(spark, source):
                raise NotPublished(name)
            files.copy(spark, source, f"{final}._part")
            files.rename(spark, f"{final}._part", final)
        return final

    return fetch


def web_publisher(url: str) -> Callable[[str, int, str], str]:
    """A publisher over HTTP: an executor reads the hour and writes it, gzipped again, to ``dest`` on the shared file system."""

    def fetch(day: str, hour: int, dest: str) -> str:
        spark, name = SparkSession.builder.getOrCreate(), lake.hour_filename(day, hour)
        final = f"{dest.rstrip('/')}/{name}"
        if not files.exists(spark, final):
            if not web.published(url, day, hour):
                raise NotPublished(name)
            rows = web.register(spark).read.format("event_archive").option("url", url).option("day", day).option("hours", f"[{hour}]").load()
            beside = f"{dest.rstrip('/')}/_{uuid.uuid4().hex}"
            rows.select("value").write.option("compression", "gzip").option("lineSep", "\n").text(beside)
            files.rename(spark, beside, final)
        return final

    return fetch


@dataclass(frozen=True)
class HourReport:
    day: str
    hour: int
    status: str | None  # None: nothing was recorded, and the hour stays due
    events: int | None = None
    detail: str | None = None


def ingest_hour(spark: SparkSession, table: LedgerTable, fetch: Callable[[str, int, str], str], archive: str, root: str, day: str, hour: int, now: datetime, keep_source: bool = True) -> HourReport:
    """One hour through all its states.

    Not published within the grace: unrecorded; after it: missing. A transport error is unrecorded. What can't be read, or
    belongs to another hour, is failed. A mistake in a query isn't caught. The source goes only after the ledger has its row.
    """

    def record(status: str, events: int | None, size: int | None, detail: str | None) -> HourReport:
        table.record((date.fromisoformat(day), hour, status, events, size, detail, now))
        return HourReport(day, hour, status, events, detail)

    try:
        path = fetch(day, hour, archive)
    except NotPublished:
        if now - hour_end(day, hour) < GRACE:
            return HourReport(day, hour, None, detail="not published yet")
        return record(MISSING, None, None, "not published")
    except OSError as e:
        return HourReport(day, hour, None, detail=str(e))
    try:
        written = lake.write_hour(spark, path, root, day, hour)
    except AnalysisException:
        raise
    except (PySparkException, OSError, ValueError) as e:
        return record(FAILED, None, None, str(e).splitlines()[0][:200])
    except Exception as e:  # Py4J wraps what executors throw on unreadable files
        if "Py4JJavaError" not in type(e).__name__:
            raise
        return record(FAILED, None, None, str(e).splitlines()[0][:200])
    report = record(INGESTED, written.events, written.bytes, None)
    if not keep_source:
        files.delete(spark, path)
    return report


def converge_once(spark: SparkSession, table: LedgerTable, fetch, archive: str, root: str, first: str, last: str, now: datetime, retry_failed: bool = False, concurrency: int = CONCURRENCY, keep_source: bool = True) -> list[HourReport]:
    """Each due hour once; one ``now`` for the whole pass. The ledger is written by one thread at a time."""
    pending = ledger.pending_hours(spark, table.read(), first, last, retry_failed)
    due = [(str(r.day), r.hour) for r in ledger.due_hours(pending, now.isoformat(" ")).orderBy("day", "hour").collect()]
    with ThreadPoolExecutor(max(1, concurrency)) as pool:
        return list(pool.map(lambda x: ingest_hour(spark, table, fetch, archive, root, *x, now, keep_source), due))


def converge_forever(spark: SparkSession, table: LedgerTable, fetch, archive: str, root: str, stop: threading.Event, clock: Callable[[], datetime], lookback: int = LOOKBACK_DAYS, seconds: float = SCAN_SECONDS, most: int | None = None, keep_source: bool = True) -> int:
    """Passes over the last days until ``stop``, or ``most`` of them; the number of passes. A pass that fails is logged and tried again."""
    passes = 0
    while not stop.is_set() and passes != most:
        now = clock()
        try:
            converge_once(spark, table, fetch, archive, root, str(now.date() - timedelta(days=lookback)), str(now.date()), now, keep_source=keep_source)
        except Exception:
            log.exception("a pass failed")
        passes += 1
        if passes != most:
            stop.wait(seconds)
    return passes


def repair(spark: SparkSession, table: LedgerTable, fetch, archive: str, root: str, now: datetime, dry_run: bool = False, count_rows: bool = True) -> list[dict]:
    """Forget claims that the files prove false, fetch their hours again, and compare; one dict for each such claim."""
    from eventpulse.operators import recon

    claims = ledger.ingested_hours(table.read())
    findings = recon.unbacked(recon.verify(claims, lake.lake_files_frame(spark, root), lake.counts_by_hour(spark, root) if count_rows else None)).orderBy("day", "hour").collect()
    if dry_run or not findings:
        return [{"day": str(f.day), "hour": f.hour, "problem": f.problem, "verdict": None} for f in findings]
    claimed = {(d, h): n for d, h, n, _ in table.forget([(f.day, f.hour) for f in findings])}
    out = []
    for f in findings:
        files.delete(spark, f"{lake.partition_dir(root, str(f.day), f.hour)}/events.parquet", False)
        r = ingest_hour(spark, table, fetch, archive, root, str(f.day), f.hour, now)
        verdict = "NOT RECOVERED" if r.status != INGESTED else "match" if r.events == claimed[f.day, f.hour] else "DIFFERS"
        out.append({"day": str(f.day), "hour": f.hour, "problem": f.problem, "verdict": verdict})
    return out

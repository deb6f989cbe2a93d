"""Feeds over HTTP against a local server."""

import gzip
import json
import os
import signal
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from eventpulse import cli
from eventpulse.plans import converge
from eventpulse.sources import lake, web

DAY = "2026-07-22"


def event(i):
    return {"id": str(i), "type": "PushEvent", "actor": {"id": 1, "login": "u"}, "repo": {"id": 2, "name": "o/r"}, "payload": {}, "public": True, "created_at": f"{DAY}T05:00:0{i % 10}Z"}


class Site:
    """What is served by path, the tag, and how often to be busy first."""

    def __init__(self):
        self.pages, self.tag, self.busy, self.asked = {}, "t1", 0, []


@pytest.fixture
def site():
    it = Site()

    class Handler(BaseHTTPRequestHandler):
        def _answer(self, send):
            it.asked.append((self.command, self.path, self.headers.get("If-None-Match"), self.headers.get("Authorization")))
            if it.busy:
                it.busy -= 1
                status, body = 503, b""
            elif self.command == "HEAD" and self.headers.get("If-None-Match") == it.tag:
                status, body = 304, b""
            elif (body := it.pages.get(self.path if self.command == "GET" else self.path.split("?")[0])) is None:
                status, body = 404, b""
            else:
                status = 200
            self.send_response(status)
            self.send_header("ETag", it.tag)
            self.send_header("Retry-After", "0")
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            if send:
                self.wfile.write(body)

        def do_GET(self):
            self._answer(True)

        def do_HEAD(self):
            self._answer(False)

        def log_message(self, *args):
            pass

    httpd = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=httpd.serve_forever, daemon=True).start()
    it.url = f"http://127.0.0.1:{httpd.server_port}"
    yield it
    httpd.shutdown()


def pages(*items):
    return json.dumps(list(items), ensure_ascii=False).encode()


def test_a_feed_is_polled_by_tag_and_comes_once(spark, site, tmp_path):
    site.pages = {"/events": b"", "/events?page=1": pages(event(1), event(2), "ünfit"), "/events?page=2": pages(event(2), {"id": "9"})}
    site.busy = 1
    args = ["poll", "--feed", f"{site.url}/events", "--folder", str(tmp_path / "out"), "--checkpoint", str(tmp_path / "c"), "--pages", "2", "--interval", "0.2", "--cycles", "1"]
    assert cli.main(args, spark) == 0
    got = spark.read.text(str(tmp_path / "out" / f"hour_key={DAY}-05"))
    assert sorted(json.loads(r.value)["id"] for r in got.collect()) == ["1", "2"]
    rejects = {r.raw for r in spark.read.json(str(tmp_path / "out-rejects")).collect()}
    assert rejects == {'"ünfit"', '{"id": "9"}'}
    first = len(site.asked)
    site.tag, site.pages["/events?page=1"] = "t2", pages(event(2), event(3))
    assert cli.main(args, spark) == 0  # started anew on its checkpoint: what was seen within the hour stays away
    assert sorted(json.loads(r.value)["id"] for r in spark.read.text(str(tmp_path / "out" / f"hour_key={DAY}-05")).collect()) == ["1", "2", "3"]
    assert {a[1] for a in site.asked[first:] if a[0] == "GET"} == {"/events?page=1", "/events?page=2"}


def test_offsets_move_with_the_tag_only(site, monkeypatch):
    site.pages = {"/events": b""}
    reader = web._Pages({"url": f"{site.url}/events", "pages": "3", "token": "secret"})
    one = reader.latestOffset()
    assert one["tag"] == "t1" and reader.latestOffset() == one and site.asked[0][3] == "Bearer secret" and site.asked[1][2] == "t1"
    site.tag = "t2"
    assert reader.latestOffset() != one and [p.value for p in reader.partitions(one, reader.offset)] == [1, 2, 3]
    monkeypatch.setattr(web.time, "sleep", lambda s: None)
    site.busy = web.TRIES
    with pytest.raises(Exception, match="503"):
        reader.latestOffset()


def test_archive_hours_by_executors(spark, site, tmp_path):
    lines = "".join(json.dumps(event(i), ensure_ascii=False) + "\n" for i in range(3)).encode()
    site.pages = {f"/{DAY}-{h}.json.gz": gzip.compress(lines) for h in (5, 6)}
    rows = web.register(spark).read.format("event_archive").option("url", site.url).option("day", DAY).option("hours", "[5, 6]").load()
    assert rows.groupBy("hour").agg(F.count("*").alias("n")).orderBy("hour").collect() == [(5, 3), (6, 3)]
    fetch = converge.web_publisher(site.url)
    path = fetch(DAY, 5, str(tmp_path / "archive"))
    assert lake.write_hour(spark, path, str(tmp_path / "lake"), DAY, 5).events == 3
    asked = len(site.asked)
    assert fetch(DAY, 5, str(tmp_path / "archive")) == path and len(site.asked) == asked
    with pytest.raises(converge.NotPublished):
        fetch(DAY, 7, str(tmp_path / "archive"))
    assert [p.name for p in (tmp_path / "archive").iterdir() if not p.name.endswith(".crc")] == [f"{DAY}-5.json.gz"]


def test_signals_end_loops_and_are_put_back():
    before = signal.getsignal(signal.SIGTERM)
    with cli._until_told() as told:
        os.kill(os.getpid(), signal.SIGTERM)
        assert told.wait(5)
    assert signal.getsignal(signal.SIGTERM) is before

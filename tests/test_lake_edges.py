"""Paths of the lake and its commands that the other tests do not take."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventpulse import cli
from eventpulse.operators.ledger import LedgerTable
from eventpulse.plans import converge
from eventpulse.sources import lake

from .test_lake_and_live import DAY, write_hour


def test_blank_lines_are_no_items_and_bad_ids_fail(spark, tmp_path):
    path = tmp_path / "items.ndjson"
    path.write_text('{"id": "1", "type": "a"}\n\n   \n{"id": "2"} \n')
    assert [r.value for r in lake.read_ndjson(spark, str(path)).collect()] == ['{"id": "1", "type": "a"}', '{"id": "2"} ']
    path.write_text('{"id": "1", "type": "a"}\nnot json\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        lake.read_ids(spark, str(path)).collect()


def test_a_source_goes_only_after_its_hour_is_recorded(spark, tmp_path):
    table, archive = LedgerTable(spark, str(tmp_path / "ledger")), tmp_path / "archive"
    for h in (0, 1):
        write_hour(tmp_path / "pub", h, **({"at": f"{DAY}T09:00:00Z"} if h else {}))
    fetch, now = converge.folder_publisher(str(tmp_path / "pub")), datetime.fromisoformat(f"{DAY}T05:30:00")
    got = [converge.ingest_hour(spark, table, fetch, str(archive), str(tmp_path / "lake"), DAY, h, now, keep_source=False).status for h in (0, 1)]
    assert got == ["ingested", "failed"] and [p.name for p in archive.glob("*.json.gz")] == [lake.hour_filename(DAY, 1)]
    assert table.read().where("status = 'ingested'").first().events == 3


def test_an_aggregate_of_another_day_is_refused(spark, tmp_path):
    rows = spark.range(3).select(F.lit("2026-07-23").cast("date").alias("day"), "id")
    with pytest.raises(lake.AggregateDayMismatch, match="from 2026-07-23"):
        lake._write_day(spark, rows, str(tmp_path), "repo", DAY)
    assert not list(tmp_path.rglob("repo_daily.parquet"))


def test_missing_hours_of_a_day_are_fetched_for_its_aggregate(spark, tmp_path, capsys):
    for h in (0, 1):
        write_hour(tmp_path / "pub", h, 12)
    args = ["aggregate", DAY, "--lake", str(tmp_path / "lake"), "--aggregates", str(tmp_path / "agg"), "--publisher", str(tmp_path / "pub"), "--archive", str(tmp_path / "archive")]
    assert cli.main(args, spark) == 3  # two of 24 hours
    assert json.loads(capsys.readouterr().out)["hours_present"] == 2
    assert cli.main(["fetch-archive", DAY, "1", "--publisher", str(tmp_path / "pub"), "--archive", str(tmp_path / "here")], spark) == 0
    assert cli.main(["fetch-archive", DAY, "5", "--publisher", str(tmp_path / "pub"), "--archive", str(tmp_path / "here")], spark) == 1


def test_passes_of_the_archive_loop(spark, tmp_path, capsys):
    args = ["archive-serve", "--lake", str(tmp_path / "lake"), "--ledger", str(tmp_path / "ledger"), "--archive", str(tmp_path / "archive"), "--publisher", str(tmp_path / "none")]
    assert cli.main([*args, "--passes", "1", "--lookback", "0"], spark) == 0 and '{"passes": 1}' in capsys.readouterr().out


def test_marts_follow_the_lake(spark, tmp_path, capsys):
    for name in ("marts", "restricted"):
        spark.sql(f"drop database if exists {name} cascade")
    root = str(tmp_path / "lake")
    lake.write_hour(spark, write_hour(tmp_path / "a", 0), root, DAY, 0)
    assert cli.main(["marts-converge", "--lake", root], spark) == 0 and '"unbuilt"' in capsys.readouterr().out
    assert spark.table("marts.ecosystem_daily").first().hours_present == 1
    assert cli.main(["marts-converge", "--lake", root], spark) == 0 and "check" not in capsys.readouterr().out

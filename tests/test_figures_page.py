import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from eventpulse.functions import show
from eventpulse.operators import figures, panels, site
from eventpulse.operators.staging import stg_events
from eventpulse.plans.catalog import Tables

SF = "/root/testdata/sf0.01"


def test_numbers_as_text(spark):
    row = spark.range(1).selectExpr("15827495 n", "1 one", "3 three", "3000 many", "0 nothing", "cast(2 as double) / 3 x", "1448310660L size", "cast(null as bigint) none", "74.6 - 68.96 spread")
    of = lambda kind, *columns, places=2: row.select(show.cell(kind, *columns, places=places)).first()[0]
    assert of("count", "n") == "15,827,495" and of("count", "none") == "0" and of("share", "one", "three") == "33.33%" and of("share", "one", "many", places=3) == "0.033%" and of("share", "none", "three") == "0.00%"
    assert of("number", "x", places=4) == "0.6667" and of("times", "x") == "0.67×" and of("number", "spread") == "5.64" and of("percent", "x") == "0.67%"
    assert of("bytes", "size") == "1.35 GiB (1,448,310,660 bytes)"
    assert show.shortened(range(12)) == "0, 1, 2, 3, 4, 5, 6, 7, 8, 9 (+2 more)" and show.shortened([1, 2]) == "1, 2" and show.shortened([]) == ""
    for whole in ("nothing", "none"):
        with pytest.raises(PySparkException, match="a share of nothing"):
            of("share", "one", whole)


def test_page_is_the_same_twice_and_refuses_disagreement(spark, monkeypatch):
    lake = Tables(spark, SF).lake
    told = [site.render(site.gather(lake, "2024-01-29", 2**30, 3, busy=3)) for _ in range(2)]
    assert told[0] == told[1] and "1.00 GiB (1,073,741,824 bytes)" in told[0] and f"<td>{lake.count():,}</td>" in told[0]
    with pytest.raises(site.FiguresDisagree, match="repo_days of 2023-01-01"):
        site.gather(lake, "2023-01-01", 1, 1, busy=3)
    real = figures.per_day_automated
    monkeypatch.setattr(figures, "per_day_automated", lambda *a: real(*a).withColumn("events", F.col("events") + 1))
    with pytest.raises(site.FiguresDisagree, match="events of 2024-01-29"):
        site.gather(lake, "2024-01-29", 1, 1, busy=3)


def test_the_payload_is_read_only_where_it_is_returned(spark, tmp_path):
    t = Tables(spark, SF)
    path = str(tmp_path / "lake")
    t.lake.write.parquet(path)
    lake = spark.read.parquet(path)
    plan = lambda rows: rows._jdf.queryExecution().executedPlan().toString()
    assert "payload#" not in plan(stg_events(lake, payload=False)) and "payload#" in plan(stg_events(lake))
    few = stg_events(lake).drop("payload")
    assert few.exceptAll(stg_events(lake, payload=False)).isEmpty() and few.columns == stg_events(lake, payload=False).columns


def test_published_panels_pass_the_guard(spark):
    ledger = spark.createDataFrame([("2026-07-22", 1, "ingested", 5)], "day string, hour int, status string, events long")
    assert panels.hours_ingested(ledger).first()["value"] == 1
    with pytest.raises(panels.NotPublishable):
        panels.publish("select * from restricted.actor_daily", ledger=ledger)
    with pytest.raises(panels.NotPublishable):
        panels.publish("select actor_login from {ledger}", ledger=ledger)
    assert json.dumps(panels.recent_hours(ledger).first().asDict()) == json.dumps({"day": "2026-07-22", "hour": 1, "status": "ingested", "events": 5})

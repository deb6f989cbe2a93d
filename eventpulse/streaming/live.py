"""The live path: feed pages split into events and rejects, messages routed to the store or to dead letters, and deduplication."""

from __future__ import annotations

import hashlib
import logging
from collections import Counter, deque
from collections.abc import Callable, Iterable, Iterator
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from eventpulse.sources import files
from eventpulse.streaming import wire

log = logging.getLogger(__name__)
WINDOW = 50_000


def admit(window: Iterable[str], arriving: Iterable[str], size: int = WINDOW) -> tuple[list[bool], list[str]]:
    """Which of the arriving ids are new to a window of the last ``size`` new ids, and the window after them.

    Seeing an id again doesn't renew its place, and an id that has left is new again.
    """
    if size < 1:
        raise ValueError("a window holds at least one id")
    line, flags = deque(window), []
    known = set(line)
    for item in arriving:
        flags.append(item not in known)
        if flags[-1]:
            line.append(item)
            known.add(item)
            if len(line) > size:
                known.discard(line.popleft())
    return flags, list(line)


def fifo_dedup(stream: DataFrame, size: int = WINDOW, id_col: str = "id", seq_col: str = "seq") -> DataFrame:
    """Exact count-bounded deduplication of (id, seq) in order of ``seq``: one sequence, so one key and one task by nature.

    The window is an array in the operator's state. A trigger's rows must be put in order, so the source's own limit on a trigger
    (``file_ids`` sets one) bounds what the task holds. For a distributed variant see ``watermark_dedup``; it is bounded by time and not the same.
    """

    def step(_key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        rows = pd.concat([p[[id_col, seq_col]] for p in parts]).sort_values(seq_col, kind="stable")
        flags, window = admit(state.get[0] if state.exists else (), rows[id_col], size)
        state.update((window,))
        yield rows[flags]

    keyed = stream.select(id_col, seq_col, F.lit(0).alias("_one"))
    return keyed.groupBy("_one").applyInPandasWithState(step, f"{id_col} string, {seq_col} long", "window array<string>", "append", "NoTimeout")


def file_ids(spark: SparkSession, path: str, files_per_trigger: int = 8) -> DataFrame:
    """A stream of (id, seq) from Parquet files, oldest first, so many files a trigger."""
    return spark.readStream.schema("id string, seq bigint").option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def watermark_dedup(stream: DataFrame, delay: str, id_col: str = "id", time_col: str = "created_at") -> DataFrame:
    """Deduplication within a delay of event time, spread over all tasks."""
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([id_col])


def dedupe_batch(rows: DataFrame, id_col: str = "id", seq_col: str = "seq") -> DataFrame:
    """The first row of each id by arrival."""
    nth = F.row_number().over(Window.partitionBy(id_col).orderBy(seq_col))
    return rows.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def split_page(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) of feed items (value: JSON text): the envelope is strict, with an aware time and a repository; the payload is open."""
    as_message = F.concat(F.lit('{"v":1,"captured_at":"1970-01-01T00:00:00Z","event":'), F.coalesce("value", F.lit("null")), F.lit("}")).cast("binary")
    told = wire.triage(items.select("*", F.lit(None).cast("binary").alias("key"), F.col("value").alias("raw")).withColumn("value", as_message))
    valid = told.where("reason is null").select("envelope.event.*", F.col("raw"))
    return valid, told.where("reason is not null").select("raw", "reason")


def summary(totals: Counter) -> dict:
    """What a consuming run came to. A message that is neither stored nor dead-lettered was stored before."""
    dead = {k.removeprefix("dead "): n for k, n in sorted(totals.items()) if k.startswith("dead ")}
    return {"consumed": totals["consumed"], "stored": totals["stored"], "duplicates": totals["consumed"] - totals["stored"] - sum(dead.values()), "dead_lettered": sum(dead.values()), "by_reason": dead}


class Store:
    """The validated store: Parquet by event date, at most one row of each (event_id, created_at)."""

    COLUMNS = "event_id string, type string, actor_id bigint, actor_login string, repo_id bigint, repo_name string, created_at timestamp, captured_at timestamp, payload string"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def read(self) -> DataFrame:
        if not files.glob(self.spark, f"{self.path}/day=*"):
            return self.spark.createDataFrame([], self.COLUMNS)
        return self.spark.read.schema(f"{self.COLUMNS}, day date").parquet(self.path)

    def insert(self, rows: DataFrame, first: date | None = None, last: date | None = None) -> int:
        """Append rows that aren't stored, so that a redelivered batch changes nothing; the number appended, which the write itself observes.

        ``first`` and ``last`` bound the rows' days: what is stored is pruned to them by partition.
        """
        new = rows.dropDuplicates(["event_id", "created_at"]).withColumn("day", F.to_date("created_at"))
        held = self.read()
        if "day" in held.columns:
            within = F.lit(True) if first is None else F.col("day").between(F.lit(first), F.lit(last))
            new = new.join(held.where(within).select("event_id", "created_at"), ["event_id", "created_at"], "left_anti").select(*new.columns)
        stored = Observation()
        # Counted after the exchange: adaptive execution drops what lies before one that turns out to be empty, and the observation with it.
        new.repartition("day").observe(stored, F.count(F.lit(1)).alias("n")).write.mode("append").partitionBy("day").parquet(self.path)
        return stored.get.get("n", 0)


def consume_batch(messages: DataFrame, store: Store, dead_letters: str) -> Counter:
    """Route one micro-batch and count its outcomes. Returning lets the stream commit it; raising has it delivered again.

    The batch is triaged once, as it is written to a folder by route; that write observes the counts and the days, so nothing is kept in memory or
    gathered to count. ``dead_letters`` is this batch's own folder and is replaced, so a batch that is delivered again leaves its dead letters once.
    """
    spark, beside = messages.sparkSession, files.shared_dir(messages.sparkSession)
    told = wire.triage(messages).withColumn("stored", F.col("reason").isNull())
    valid = wire.store_rows(told.where("stored"))
    routes = Observation()
    day = F.to_date(F.try_to_timestamp(F.col("envelope.event.created_at")))
    counts = [F.count_if(F.col("reason") == r).cast("bigint").alias(r) for r in wire.REASONS]
    seen = told.observe(routes, F.count(F.lit(1)).alias("consumed"), *counts, F.min(F.when(F.col("stored"), day)).alias("first"), F.max(F.when(F.col("stored"), day)).alias("last"))
    try:
        seen.write.partitionBy("stored").parquet(beside)
        found = routes.get
        outcome = Counter(consumed=found.get("consumed", 0)) + Counter({f"dead {r}": found.get(r, 0) for r in wire.REASONS})
        again = spark.read.schema(seen.schema).parquet(beside)
        if outcome["consumed"] > (dead := sum(found.get(r, 0) for r in wire.REASONS)):
            outcome["stored"] = store.insert(wire.store_rows(again.where("stored")).select(*valid.columns), found["first"], found["last"])
        if dead:
            wire.dead_letters(again.where("not stored").drop("stored")).write.mode("overwrite").parquet(dead_letters)
        return outcome
    finally:
        files.delete(spark, beside)


def consume(messages: DataFrame, store: Store, dead_letter_path: str, checkpoint: str, totals: Counter, available_now: bool = True):
    """A streaming query over (key, value) messages: stored first, committed after. ``totals`` grows batch by batch.

    Dead letters stand in a folder for each stream, told by its checkpoint, and batch.
    """
    stream = hashlib.md5(checkpoint.encode()).hexdigest()[:12]
    route = lambda batch, nth: totals.update(consume_batch(batch, store, f"{dead_letter_path.rstrip('/')}/stream={stream}/batch={nth}"))
    writer = messages.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def send_messages(messages: DataFrame, servers: str, topic: str) -> None:
    """Write (key, value) messages, dead letters too, to a topic; needs Spark's Kafka connector. Returns when all are acknowledged."""
    messages.select("key", "value").write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def send_stream(messages: DataFrame, servers: str, topic: str, checkpoint: str):
    """The same for a stream, batch by batch."""
    return messages.select("key", "value").writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).option("checkpointLocation", checkpoint).start()


def kafka_messages(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Messages of a topic from the earliest on; needs Spark's Kafka connector."""
    stream = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", "earliest")
    return stream.load().select("key", "value")


def file_messages(spark: SparkSession, path: str) -> DataFrame:
    """Messages from Parquet files of (key, value)."""
    return spark.readStream.schema("key binary, value binary").parquet(path)


def write_hourly(rows: DataFrame, path: str, time_col: str = "created_at", value_col: str = "value") -> None:
    """Append NDJSON lines under the hour of their event; a batch may straddle hours."""
    rows.select(wire.hour_key(F.col(time_col)).alias("hour_key"), value_col).write.mode("append").partitionBy("hour_key").text(path)


def write_rejects(rejected: DataFrame, path: str) -> int:
    """Append rejects; nothing is created while there are none."""
    count = rejected.count()
    if count:
        rejected.write.mode("append").json(path)
    return count


def write_in_order(batch: DataFrame, must: Callable[[DataFrame], None], *extra: Callable[[DataFrame], None]) -> list[str]:
    """Give a batch to the sink that must take it, whose failure raises, and then to the extra ones; what went wrong with these."""
    must(batch)
    missed = []
    for sink in extra:
        try:
            sink(batch)
        except Exception as e:
            log.exception("a best-effort sink failed")
            missed.append(f"{type(e).__name__}: {e}")
    return missed

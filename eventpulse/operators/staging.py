"""From lake rows to one typed row per event id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventpulse.functions.events import json_text

#: What the tie of rows of one id and time goes by; the payload comes after these, and only where it is asked for.
_TIES = ("dt", "hr", "type", "actor", "repo", "org", "public")
#: Slots of the map of repeated ids. Its words of 64 slots are broadcast: at most SLOTS / 64 pairs of numbers, 16 MB, whatever the lake.
SLOTS = 1 << 26


def staged(lake: DataFrame, payload: bool = True) -> DataFrame:
    """Typed columns of every lake row, duplicates included."""
    return lake.select(
        F.col("id").alias("event_id"), F.col("type").alias("event_type"),
        json_text("actor", "id").cast("bigint").alias("actor_id"), json_text("actor", "login").alias("actor_login"),
        json_text("repo", "id").cast("bigint").alias("repo_id"), json_text("repo", "name").alias("repo_name"), json_text("org", "login").alias("org_login"),
        F.col("public").alias("is_public"), "created_at", *(["payload"] if payload else []), F.col("dt").alias("archive_day"), F.col("hr").alias("archive_hour"),
    )


def _bit(slot: str) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.col(slot), F.lit(64)).cast("int"))


def repeated(rows: DataFrame, keys: list[str], slots: int = SLOTS) -> DataFrame:
    """A bitmap (word, mask) of the hash slots of keys that more than one row has.

    Only hashes are shuffled, counted map-side first; the words are put together from the few that repeat.
    """
    hashes = rows.select(F.xxhash64(*keys).alias("hash")).groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
    at = hashes.select(F.pmod("hash", F.lit(slots)).alias("slot"))
    return at.groupBy(F.floor(F.col("slot") / 64).alias("word")).agg(F.bit_or(_bit("slot")).alias("mask"))


def among(rows: DataFrame, keys: list[str], words: DataFrame, slots: int = SLOTS, inside: bool = True) -> DataFrame:
    """Rows whose key's slot is in the bitmap, or those whose isn't."""
    told = rows.withColumn("_slot", F.pmod(F.xxhash64(*keys), F.lit(slots)))
    told = told.join(F.broadcast(words.select(F.col("word").alias("_word"), "mask")), F.floor(F.col("_slot") / 64) == F.col("_word"), "left")
    hit = F.coalesce(F.col("mask").bitwiseAND(_bit("_slot")) != 0, F.lit(False))
    return told.where(hit if inside else ~hit).select(*rows.columns)


def first_of_each(rows: DataFrame, keys: list[str], order: Column, slots: int = SLOTS) -> DataFrame:
    """The row of each key that comes first by ``order``, a struct that is never null.

    Rows whose key's slot isn't in the bitmap of repeated keys have no copy: they pass through where they are, neither sorted nor
    shuffled. The others, copies and the few whose slot is taken by another key, go through an aggregate that combines map-side. A slot
    that is taken by chance costs a shuffle of that row and changes nothing. Null keys are one key.
    """
    words = repeated(rows, keys, slots)
    alone = among(rows, keys, words, slots, inside=False)
    best = among(rows, keys, words, slots).groupBy(*keys).agg(F.min_by(F.struct(*rows.columns), order).alias("_first"))
    return alone.union(best.select("_first.*"))


def stg_events(lake: DataFrame, scope: str = "lake", payload: bool = True) -> DataFrame:
    """One row per event id: the earliest, undated rows last, ties by the columns of ``_TIES`` in order.

    Without ``payload``, which is most of a lake's bytes, it is neither read nor shuffled; the row chosen has the same
    columns either way, since the payload decides only among rows that agree in all others.
    Copies of an id are looked for in the whole ``lake``, or within each ``day``: then a filter on the day reaches the scan.
    """
    keys = ["id"] if scope == "lake" else ["dt", "id"]
    wanted = [c for c in lake.columns if payload or c != "payload"]
    order = F.struct(F.col("created_at").isNull().alias("undated"), "created_at", *_TIES, *(["payload"] if payload else []))
    # Deduplicated before the JSON is taken apart: the rows that go aren't parsed.
    return staged(first_of_each(lake.select(*wanted), keys, order), payload)

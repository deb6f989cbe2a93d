"""Leaderboard change feed: the ten best-selling items of each nation, day of arrival by day of arrival, as a stateful stream of changes.

Lines are priced and given their nation once, by joins that adaptive execution can split, cut into batches of arrival days, and written. Each batch is then fed to a
streaming query started anew on the same checkpoint. Its state, by ``applyInPandasWithState``, is that of a nation and a share of the items (``ITEMS`` of them on average,
so that no nation's revenue must fit into one task): the revenue of each item, serialized, over which a max-heap with lazy deletion is kept. An entry is stale where its revenue isn't
the item's any more; stale ones are skipped while ten valid ones are popped, which are pushed back after the day. Lines are summed up by item and day before they are shuffled to the
state, so a hot item or nation arrives as a few rows from each task.

The stream tells how the ten best of each share change. A nation's ten best are among those of its shares: each change holds until the next one of the item, days are laid out,
and the ranking keeps ten rows a nation and day in each task before it shuffles (a limit by rank). Two boards a day apart make the feed.

What reaches the driver: the number of items and, for each batch, its latest day. Nothing is broadcast.

Defined results: lines without a nation or an item are left out, but count for how late is late. Repeated lines count each. Of repeated items the greatest price holds, of repeated vendors the
least nation. Days before the first batch belong to it. Null amounts take quantity and price, null ones 0. Ties of revenue go to the smaller item. Extra columns are ignored. An empty table has no changes.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from eventpulse.sources import files

from .common import CRC_TABLE, crc32_sql, materialize, table

TOP, BATCHES, FIRST_DAY, DAYS, LATEST = 10, 8, 19723, 180, 15
#: Items of a nation that one state holds, on average.
ITEMS = 4096
_COMBINE = 1 << 17
_FED = "sold_day long, day long, nation_id int, item_id long, cents long, batch int"
_CHANGES = "nation_id int, share int, day long, item_id long, cents long, held boolean"
_STATE = "items binary, cents binary, board_items binary, board_cents binary, last_day long"


def _cents(amount: Column) -> Column:
    return F.floor(100 * amount + 0.5)


def batch_of(day: Column) -> Column:
    """The batch of an arrival day."""
    return F.greatest(F.lit(1), F.least(F.lit(BATCHES), 1 + F.floor((day - FIRST_DAY) * BATCHES / F.lit(DAYS)))).cast("int")


def priced(lines: DataFrame, items: DataFrame, vendors: DataFrame) -> DataFrame:
    """One row a line: its day, day of arrival, nation, item, signed cents and batch; what is to be left out has no nation."""
    name = F.concat_ws(",", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("sale_id", "item_id", "vendor_id", "line_no")))
    h = F.crc32(name.cast("binary"))
    sold = F.coalesce(F.datediff(F.to_date("shipped_at"), F.lit("1970-01-01").cast("date")).cast("long"), FIRST_DAY + F.col("h") % 150)
    arrived = F.col("sold_day") + F.col("h") % 7 + F.when(F.col("h") % 5 == 0, 20).otherwise(0)
    rows = lines.select("item_id", "vendor_id", "quantity", "amount", (F.col("flag").eqNullSafe("swapped")).alias("swapped"), "shipped_at", h.alias("h"))
    rows = rows.withColumn("sold_day", sold).withColumn("day", arrived)
    rows = rows.select("item_id", "vendor_id", "quantity", F.when(F.col("amount").isNotNull(), _cents(F.col("amount"))).alias("cents"), "swapped", "sold_day", "day")
    nations = vendors.where("vendor_id is not null").groupBy("vendor_id").agg(F.min("nation_id").cast("int").alias("nation_id"))
    prices = items.where("item_id is not null").groupBy("item_id").agg(F.max("price").alias("price")).withColumn("known", F.lit(True))
    # Written first: a join whose sides come straight from a shuffle is split where a vendor or an item is hot.
    nations, prices = materialize(nations, "feed-nations"), materialize(prices, "feed-prices")
    rows = rows.hint("merge").join(nations.hint("merge"), "vendor_id", "left").drop("vendor_id")
    rows = rows.hint("merge").join(prices.hint("merge"), "item_id", "left")
    cents = F.coalesce("cents", (F.col("quantity").cast("double") * _cents(F.col("price"))).cast("long"), F.lit(0))
    return rows.select(
        F.col("sold_day").cast("long").alias("sold_day"), F.col("day").cast("long").alias("day"), F.when(F.col("known"), F.col("nation_id")).alias("nation_id"), "item_id",
        F.when(F.col("swapped"), -cents).otherwise(cents).cast("long").alias("cents"), batch_of(F.col("day")).alias("batch"),
    )


def _combine(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by nation, share, item and day of what a task has read, so that a hot key leaves it as a few rows."""
    keys, held, rows = ["nation_id", "share", "item_id", "day"], [], 0
    schema = None

    def summed() -> list[pa.RecordBatch]:
        sums = pa.Table.from_batches(held).group_by(keys, use_threads=False).aggregate([("cents", "sum")])
        return sums.rename_columns([c.removesuffix("_sum") for c in sums.column_names]).select(schema.names).cast(schema).combine_chunks().to_batches()

    for part in parts:
        schema = part.schema
        held.append(part)
        rows += part.num_rows
        if rows >= 2 * _COMBINE:
            held = summed()
            rows = sum(b.num_rows for b in held)
            if rows >= _COMBINE:
                yield from held
                held, rows = [], 0
    if held:
        yield from summed()


def _pack(numbers: np.ndarray) -> bytes:
    return zlib.compress(np.diff(numbers, prepend=numbers.dtype.type(0)).tobytes(), 1)


def _unpack(data: bytes) -> list[int]:
    return np.cumsum(np.frombuffer(zlib.decompress(data), np.int64)).tolist()


class Board:
    """Revenues of items, and a max-heap over those above zero whose stale entries go only when they come up."""

    def __init__(self, revenue: dict[int, int]) -> None:
        self.revenue = revenue
        self._rebuild()

    def _rebuild(self) -> None:
        self.heap = [(-c, i) for i, c in self.revenue.items() if c > 0]
        heapq.heapify(self.heap)

    def add(self, item: int, cents: int) -> None:
        now = self.revenue[item] = self.revenue.get(item, 0) + cents
        if now > 0:
            heapq.heappush(self.heap, (-now, item))
        if len(self.heap) > 2 * len(self.revenue) + 64:
            self._rebuild()

    def best(self, top: int = TOP) -> dict[int, int]:
        """The greatest revenues, ties to the smaller item, in order."""
        valid: list[tuple[int, int]] = []
        while self.heap and len(valid) < top:
            entry = heapq.heappop(self.heap)
            if self.revenue[entry[1]] == -entry[0] and (not valid or valid[-1] != entry):  # an item may come back to a revenue it had
                valid.append(entry)
        for entry in valid:
            heapq.heappush(self.heap, entry)
        return {i: -c for c, i in valid}


def share_changes(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One batch of a share: how its board's members and their revenues change, day by day."""
    revenue, shown, last = {}, {}, None
    if state.exists:
        items, cents, board_items, board_cents, last = state.get
        revenue, shown = dict(zip(_unpack(items), _unpack(cents))), dict(zip(_unpack(board_items), _unpack(board_cents)))
    sums: dict[tuple[int, int], int] = {}
    for part in parts:
        for d, i, c in zip(part["day"].tolist(), part["item_id"].tolist(), part["cents"].tolist()):
            sums[d, i] = sums.get((d, i), 0) + c
    board, out, rows = Board(revenue), [], sorted(sums.items())
    if last is not None and rows and rows[0][0][0] <= last:
        raise ValueError(f"day {rows[0][0][0]} comes after day {last}")
    for k, ((day, item), cents) in enumerate(rows):
        board.add(item, cents)
        if k + 1 == len(rows) or rows[k + 1][0][0] != day:
            now = board.best()
            out += [(day, i, c, True) for i, c in now.items() if shown.get(i) != c]
            out += [(day, i, revenue[i], False) for i in shown if i not in now]
            shown, last = now, day
    keep = np.array(sorted(revenue.items()), np.int64).reshape(-1, 2)
    own = np.array(list(shown.items()), np.int64).reshape(-1, 2)
    state.update((_pack(keep[:, 0]), _pack(keep[:, 1]), _pack(own[:, 0]), _pack(own[:, 1]), last))
    days, items, cents, held = zip(*out) if out else ((), (), (), ())
    yield pd.DataFrame({"nation_id": np.full(len(out), key[0], np.int32), "share": np.full(len(out), key[1], np.int32), "day": np.array(days, np.int64), "item_id": np.array(items, np.int64), "cents": np.array(cents, np.int64), "held": np.array(held, bool)})


def feed_batches(spark: SparkSession, rows: DataFrame, base: str, shares: int) -> DataFrame:
    """The changes of all shares: batch after batch is moved into the folder that a stateful stream reads, which is started anew for each."""
    rows.write.partitionBy("batch").parquet(f"{base}/cut")
    cut = spark.read.schema(_FED).parquet(f"{base}/cut")
    latest = {r.batch: r.day for r in cut.groupBy("batch").agg(F.max("sold_day").alias("day")).collect()}
    before = None
    for batch in sorted(latest):
        files.rename(spark, f"{base}/cut/batch={batch}", f"{base}/fed/batch={batch}")
        lines = spark.readStream.schema(_FED).parquet(f"{base}/fed").where("nation_id is not null")
        if before is not None:
            lines = lines.where(F.col("sold_day") + LATEST >= before)
        share = F.pmod(F.xxhash64("item_id"), F.lit(shares)).cast("int").alias("share")
        sums = lines.select("nation_id", share, "item_id", "day", "cents").mapInArrow(_combine, "nation_id int, share int, item_id long, day long, cents long")
        changes = sums.groupBy("nation_id", "share").applyInPandasWithState(share_changes, _CHANGES, _STATE, "append", GroupStateTimeout.NoTimeout)
        changes.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start(f"{base}/changes").awaitTermination()
        before = max(latest[batch], before if before is not None else latest[batch])
    return spark.read.schema(_CHANGES).parquet(f"{base}/changes") if latest else spark.createDataFrame([], _CHANGES)


def board_changes(changes: DataFrame) -> DataFrame:
    """From changes within shares to the feed of the nations' boards."""
    last = changes.agg(F.max("day")).first()[0] or 0
    until = F.coalesce(F.lead("day").over(Window.partitionBy("nation_id", "item_id").orderBy("day")), F.lit(last + 1))
    spans = changes.withColumn("until", until)
    shown = spans.where("held and until > day").select("nation_id", "item_id", "cents", F.explode(F.sequence("day", F.col("until") - 1)).alias("day"))
    nth = F.row_number().over(Window.partitionBy("nation_id", "day").orderBy(F.desc("cents"), "item_id"))
    boards = shown.withColumn("rank", nth).where(F.col("rank") <= TOP)
    both = boards.select("nation_id", "day", "item_id", F.col("rank").alias("new_rank"), F.lit(None).cast("int").alias("old_rank"), "cents")
    both = both.union(boards.where(F.col("day") < last).select("nation_id", F.col("day") + 1, "item_id", F.lit(None).cast("int"), "rank", F.lit(None).cast("long")))
    keys = ["nation_id", "day", "item_id"]
    met = both.groupBy(*keys).agg(F.max("new_rank").alias("new_rank"), F.max("old_rank").alias("old_rank"), F.max("cents").alias("cents")).where("not (new_rank <=> old_rank)")
    # What an item that left the board has now: it stays in its share's ten best or has just left them, which says it too.
    known = shown.select(*keys, "cents").union(changes.where("not held").select(*keys, "cents")).withColumnRenamed("cents", "_now")
    gone = met.where("new_rank is null").drop("cents").join(known, keys).withColumnRenamed("_now", "cents")
    change = F.when(F.col("old_rank").isNull(), "enter").when(F.col("new_rank").isNull(), "exit").otherwise("move")
    out = met.where("new_rank is not null").unionByName(gone)
    return out.select("nation_id", F.col("day").alias("arrival_day"), "item_id", batch_of(F.col("day")).alias("batch"), change.alias("change"), "old_rank", "new_rank", F.col("cents").alias("revenue"))


def change_feed(lines: DataFrame, items: DataFrame, vendors: DataFrame, items_a_state: int = ITEMS) -> DataFrame:
    spark, base = lines.sparkSession, files.shared_dir(lines.sparkSession)
    shares = max(1, -(-items.count() // items_a_state))
    return board_changes(feed_batches(spark, priced(lines, items, vendors), base, shares))


def op12_leaderboard_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_feed(*(table(spark, sf_dir, t) for t in ("sale_lines", "items", "vendors")))


QUERIES = {"op12_leaderboard_change_feed": op12_leaderboard_change_feed}
_NAME = "coalesce(sale_id::varchar, '') || ',' || coalesce(item_id::varchar, '') || ',' || coalesce(vendor_id::varchar, '') || ',' || coalesce(line_no::varchar, '')"
ORACLES = {
    "op12_leaderboard_change_feed": f"""with {CRC_TABLE},
h0 as (select *, {crc32_sql(_NAME)} h from sale_lines, crc),
h1 as (select *, coalesce(shipped_at::date - date '1970-01-01', {FIRST_DAY} + h % 150) s from h0),
h2 as (select *, s + h % 7 + case when h % 5 = 0 then 20 else 0 end a from h1),
h3 as (select *, greatest(1, least({BATCHES}, 1 + floor((a - {FIRST_DAY}) * {BATCHES} / {DAYS}.0)))::int batch from h2),
tops as (select batch, max(s) over_s from h3 group by batch),
late as (select batch, max(over_s) over (order by batch rows between unbounded preceding and 1 preceding) before from tops),
used as (select v.nation_id, l.item_id, l.a, case when flag = 'swapped' then -1 else 1 end * coalesce(floor(100 * amount + 0.5), quantity::double * floor(100 * i.price + 0.5), 0) cents
  from h3 l join late using (batch) join items i using (item_id) join vendors v using (vendor_id) where v.nation_id is not null and (before is null or s + {LATEST} >= before)),
days as (select nation_id, item_id, a, sum(cents) cents from used group by nation_id, item_id, a),
sums as (select nation_id, item_id, a, sum(cents) over (partition by nation_id, item_id order by a) total, lead(a) over (partition by nation_id, item_id order by a) until from days),
ends as (select nation_id, min(a) first_a, max(a) last_a from used group by nation_id),
daily as (select s.nation_id, s.item_id, d.day, s.total from sums s join ends using (nation_id), unnest(generate_series(s.a, coalesce(s.until - 1, last_a))) d(day)),
boards as (select *, row_number() over (partition by nation_id, day order by total desc, item_id) r from daily where total > 0 qualify r <= {TOP}),
steps as (select coalesce(n.nation_id, o.nation_id) nation_id, coalesce(n.day, o.day + 1) arrival_day, coalesce(n.item_id, o.item_id) item_id, o.r old_rank, n.r new_rank
  from boards n full join boards o on o.nation_id = n.nation_id and o.item_id = n.item_id and o.day + 1 = n.day where n.r is distinct from o.r)
select t.nation_id, arrival_day::bigint arrival_day, t.item_id, greatest(1, least({BATCHES}, 1 + floor((arrival_day - {FIRST_DAY}) * {BATCHES} / {DAYS}.0)))::int batch,
 case when old_rank is null then 'enter' when new_rank is null then 'exit' else 'move' end "change", old_rank::int old_rank, new_rank::int new_rank, d.total::bigint revenue
 from steps t join ends e on e.nation_id = t.nation_id join daily d on d.nation_id = t.nation_id and d.item_id = t.item_id and d.day = arrival_day where arrival_day <= last_a"""
}

"""Resharding by minimum-cost flow: from old shard sizes and new capacities, move the fewest bytes.

Old shards are cut into blocks: a shard's rows of one size class, the classes being ranges of sizes common to all shards. A flow network takes
each block's rows either to the shard they are in, at no cost, or through a pool to any other
shard, at the block's mean bytes a row (a shard's blocks are parallel edges, one arc of convex cost, so that a path is looked for among shards and not among blocks); each new shard takes at least and at most what its capacity
says. The cheapest flow says how many rows each old shard gives away; its smallest rows go. Where one shard gives away rows of a class
while another keeps some of it, the choice between them hangs on the sizes within the class: such classes are counted again in finer ranges, and the flow
is solved again, until each of them is of a single size. Then no exchange of rows can save a byte, so the bytes moved are the fewest there are.
The plan is a short list of intervals of a shard's rows in order of
size; every row finds its interval by its rank, and its slot by its place in the interval.

Ranks come from one range-partitioned sort by (shard, size, checksum, id, row) and the row counts of its
partitions, so a shard with a third of all rows, or a third of all texts alike, null ids among them, is spread over many
tasks. The driver sees only counts by (shard, partition) and (shard, size class).

Defined results: null text has size 16 and checksum 0; null ids are ordinary rows; repeated rows each
get a slot of their own; an empty table gives no rows. Extra columns stay untouched by
``rewrite_affected`` and are left out of the layout unless it carries the rows; a clash with its columns raises ValueError.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventpulse.sources import files

from .common import fold, local_rows, materialize, table

OVERHEAD = 16
OLD_SHARDS, NEW_SHARDS = 44, 40
_FINER = 4


class MinCostFlow:
    """Successive shortest paths with potentials; capacities and costs are non-negative integers.

    Edges between the same two nodes are one arc of convex cost: a path sees the cheapest that has room and, backwards, the dearest in use, so
    its search is over nodes, however many edges they have.
    """

    def __init__(self) -> None:
        self.edges: list[tuple[int, int]] = []  # (capacity, cost)
        self.used: list[int] = []
        self.between: dict[tuple[object, object], list[int]] = defaultdict(list)

    def edge(self, a: object, b: object, capacity: int, cost: int) -> int:
        self.between[a, b].append(len(self.edges))
        self.edges.append((capacity, cost))
        self.used.append(0)
        return len(self.edges) - 1

    def flow_on(self, edge: int) -> int:
        return self.used[edge]

    def _residual(self, arc: list, ahead: bool) -> tuple[int, int, int] | None:
        """(edge, room, price) of an arc: [edges in order of cost, how many of them are full]."""
        ids, full = arc
        if ahead:
            return (ids[full], self.edges[ids[full]][0] - self.used[ids[full]], self.edges[ids[full]][1]) if full < len(ids) else None
        at = full if full < len(ids) and self.used[ids[full]] else full - 1
        return (ids[at], self.used[ids[at]], -self.edges[ids[at]][1]) if at >= 0 else None

    def solve(self, source: object, sink: object) -> tuple[int, int]:
        """Send all that fits; returns (amount, cost)."""
        out: dict[object, list[tuple[object, list, bool]]] = defaultdict(list)
        for (a, b), ids in self.between.items():
            if some := sorted((e for e in ids if self.edges[e][0]), key=lambda e: self.edges[e][1]):
                arc = [some, 0]
                out[a].append((b, arc, True))
                out[b].append((a, arc, False))
        potential: dict[object, int] = defaultdict(int)
        amount = cost = 0
        while True:
            dist, via, queue, tick = {source: 0}, {}, [(0, 0, source)], 0
            while queue:
                d, _, node = heapq.heappop(queue)
                if node == sink:
                    break
                if d > dist[node]:
                    continue
                for to, arc, ahead in out[node]:
                    left = self._residual(arc, ahead)
                    if left and (nd := d + left[2] + potential[node] - potential[to]) < dist.get(to, float("inf")):
                        dist[to], via[to], tick = nd, (node, arc, ahead, left), tick + 1
                        heapq.heappush(queue, (nd, tick, to))
            if sink not in dist:
                return amount, cost
            far = dist[sink]
            for node in list(out):
                potential[node] += min(dist.get(node, far), far)
            path, node = [], sink
            while node != source:
                path.append(via[node])
                node = via[node][0]
            step = min(left[1] for *_, left in path)
            for _, arc, ahead, (edge, _, price) in path:
                self.used[edge] += step if ahead else -step
                cost += step * price
                ids, full = arc
                if not ahead:
                    arc[1] = full if full < len(ids) and ids[full] == edge else full - 1
                elif self.used[edge] == self.edges[edge][0]:
                    arc[1] = full + 1
            amount += step


@dataclass(frozen=True)
class Transfer:
    """Rows ``lo`` to ``hi`` (exclusive), in order of size, of ``old`` go to ``new`` from ``slot`` on."""

    old: int
    lo: int
    hi: int
    new: int
    slot: int


def even_capacities(rows: int, shards: int) -> list[tuple[int, int]]:
    """(least, most) rows of each shard such that counts are at most one apart."""
    return [(rows // shards, -(-rows // shards))] * shards


def solve_flow(blocks: list[tuple[int, int, int]], capacities: list[tuple[int, int]]) -> tuple[list[int], dict[int, int]]:
    """The rows that stay of each block (old shard, rows, bytes), and the rows that each new shard gets, at the fewest bytes.

    ``capacities`` are (least, most) rows of each new shard; ValueError where they can't hold the rows, or ask for more.
    """
    net, held = MinCostFlow(), defaultdict(int)
    total, least = sum(b[1] for b in blocks), sum(c[0] for c in capacities)
    if not least <= total <= sum(c[1] for c in capacities):
        raise ValueError(f"{total} rows do not fit capacities of {least} to {sum(c[1] for c in capacities)}")
    gone = []  # a shard's blocks are parallel edges to the pool, so of a shard the cheapest rows go first
    for old, rows, weight in blocks:
        held[old] += rows
        gone.append(net.edge(("old", old), "pool", rows, max(1, round(weight / max(rows, 1)))))
    for old, rows in held.items():
        net.edge("source", ("old", old), rows, 0)
        if 0 <= old < len(capacities):
            net.edge(("old", old), ("shard", old), rows, 0)
    gets = {}
    for new, (low, high) in enumerate(capacities):
        gets[new] = net.edge("pool", ("shard", new), high, 0)
        net.edge(("shard", new), "sink", low, 0)
        net.edge(("shard", new), "spare", high - low, 0)
    net.edge("spare", "sink", total - least, 0)
    net.solve("source", "sink")
    return [rows - net.flow_on(e) for (_, rows, _), e in zip(blocks, gone)], {new: net.flow_on(e) for new, e in gets.items()}


def plan_transfers(blocks: list[tuple[int, int, int]], capacities: list[tuple[int, int]]) -> list[Transfer]:
    """The flow as intervals of each old shard's rows in order of size."""
    stay, gets = solve_flow(blocks, capacities)
    size, kept = defaultdict(int), defaultdict(int)
    for (old, rows, _), k in zip(blocks, stay):
        size[old] += rows
        kept[old] += k
    plan, filled, wanting = [], defaultdict(int), iter([[n, g] for n, g in gets.items() if g])
    for old in sorted(size):
        if kept[old]:  # what stays has the first slots of its shard
            plan.append(Transfer(old, size[old] - kept[old], size[old], old, 0))
            filled[old] = kept[old]
    taker = next(wanting, None)
    for old in sorted(size):
        at, end = 0, size[old] - kept[old]
        while at < end:
            step = min(end - at, taker[1])
            plan.append(Transfer(old, at, at + step, taker[0], filled[taker[0]]))
            filled[taker[0]] += step
            taker[1] -= step
            at += step
            if not taker[1]:
                taker = next(wanting, None)
    return plan


@dataclass
class SizeClass:
    """Sizes from ``low`` to ``high`` inclusive, and the (rows, bytes) of each shard."""

    low: int
    high: int
    of: dict[int, tuple[int, int]]


def exact_classes(count: Callable[[list[tuple[int, int, int]]], list[tuple[int, int, int, int, int, int, int]]], rows: int, shards: int) -> list[tuple[int, int, int]]:
    """Blocks whose flow moves the fewest bytes, from a function that counts ranges of sizes.

    ``count`` takes ranges (low, high, step), or none for powers of two, and returns (range, start, shard, rows, bytes, least, greatest size) for each step of a range that a shard has rows in.
    """

    def classes(ranges: list[tuple[int, int, int]]) -> list[SizeClass]:
        found: dict[tuple[int, int], SizeClass] = {}
        for nth, start, old, n, weight, least, greatest in count(ranges):
            c = found.setdefault((nth, start), SizeClass(least, greatest, {}))
            c.low, c.high, c.of[old] = min(c.low, least), max(c.high, greatest), (n, weight)
        return sorted(found.values(), key=lambda c: c.low)

    def blocks_of(these: list[SizeClass]) -> list[tuple[int, int, int]]:
        return [(old, *c.of[old]) for old in sorted({x for c in these for x in c.of}) for c in these if old in c.of]

    now, capacities = classes([]), even_capacities(rows, shards)
    while True:
        blocks = blocks_of(now)
        stay = iter(solve_flow(blocks, capacities)[0])
        kept = {(old, id(c)): next(stay) for old in sorted({x for c in now for x in c.of}) for c in now if old in c.of}
        states = []
        for c in now:  # shards that keep some of the class, and those that give some away and could have kept it
            keep, give = {x for x in c.of if kept[x, id(c)]}, {x for x in c.of if x < shards and kept[x, id(c)] < c.of[x][0]}
            states.append("open" if keep and give and len(keep | give) > 1 and c.low < c.high else "single" if keep and give else "keep" if keep else "give")
        if "open" not in states:
            return blocks
        told = [c for c, s in zip(now, states) if s == "open"]
        now = _merged(now, states) + classes([(c.low, c.high, -(-(c.high - c.low + 1) // _FINER)) for c in told])
        now.sort(key=lambda c: c.low)


def _merged(these: list[SizeClass], states: list[str]) -> list[SizeClass]:
    """Neighbours that are wholly kept, or wholly given away, as one class; open classes are left out."""
    out: list[SizeClass] = []
    last = None
    for c, s in zip(these, states):
        if s == last and s in ("keep", "give"):
            both = {x: tuple(map(sum, zip(out[-1].of.get(x, (0, 0)), c.of.get(x, (0, 0))))) for x in out[-1].of.keys() | c.of.keys()}
            out[-1] = SizeClass(out[-1].low, c.high, both)
        elif s != "open":
            out.append(c)
        last = s
    return out


def stepped(sizes: DataFrame, ranges: list[tuple[int, int, int]]) -> DataFrame:
    """(nth, start, old_shard, size, n) of the (old_shard, size, n) that one of the disjoint ranges (low, high, step) holds: which range, and which of its steps.

    The ranges are looked up by bisection, since there can be thousands: an expression of a branch for each doesn't fit the driver.
    """
    lows, highs, steps = (np.array(x, np.int64) for x in zip(*sorted(ranges)))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            size = part.column(1).to_numpy()
            at = np.maximum(np.searchsorted(lows, size, "right") - 1, 0)
            inside = (size >= lows[at]) & (size <= highs[at])
            of = part.filter(pa.array(inside))
            yield pa.RecordBatch.from_arrays([pa.array(at[inside]), pa.array(((size - lows[at]) // steps[at])[inside]), *of.columns], ["nth", "start", "old_shard", "size", "n"])

    return sizes.select("old_shard", "size", "n").mapInArrow(batches, "nth long, start long, old_shard int, size long, n long")


def layout(docs: DataFrame, old_shard: Column, shards: int, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """(doc_id, size, text_crc32, old_shard, shard, slot) of every row; row counts of shards are at most one apart.

    With ``carry`` a last column ``carried`` holds the whole row, which ``rewrite_affected`` needs where ids are null or repeated.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        old_shard.cast("int").alias("old_shard"),
        *([F.struct(*docs.columns).alias("carried")] if carry else []),
    )
    order = ["old_shard", "size", "text_crc32", "doc_id", "_tie"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))  # only tells rows apart that are alike
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = materialize(placed.select("*", F.shiftright("_at", 33).cast("int").alias("_part"), F.col("_at").bitwiseAND((1 << 33) - 1).alias("_row")).drop("_at", "_tie"), "ranked")
    spans = {(r["old_shard"], r["_part"]): (r["n"], r["first"]) for r in placed.groupBy("old_shard", "_part").agg(F.count("*").alias("n"), F.min("_row").alias("first")).collect()}

    sizes = materialize(placed.groupBy("old_shard", "size").agg(F.count("*").alias("n")), "sizes")

    def count(ranges: list[tuple[int, int, int]]) -> list[tuple]:
        each = stepped(sizes, ranges) if ranges else sizes.select(F.lit(0).alias("nth"), F.floor(F.log2("size")).cast("long").alias("start"), "old_shard", "size", "n")
        return [tuple(r) for r in each.groupBy("nth", "start", "old_shard").agg(F.sum("n").alias("n"), F.sum(F.col("size") * F.col("n")).alias("bytes"), F.min("size").alias("least"), F.max("size").alias("greatest")).collect()]

    total = sum(n for n, _ in spans.values())
    plan = plan_transfers(exact_classes(count, total, shards), even_capacities(total, shards)) if total else []
    of = defaultdict(list)
    for t in plan:
        of[t.old].append(t)
    pieces, before = [], defaultdict(int)  # the plan by partition: rows from..to of a partition's shard, where they go, and slot minus row
    for (old, part), (n, first) in sorted(spans.items()):
        start = before[old]
        before[old] += n
        for t in of[old]:
            lo, hi = max(t.lo, start), min(t.hi, start + n)
            if lo < hi:
                pieces.append((old, part, lo - start + first, hi - start + first, t.new, t.slot + lo - t.lo - (lo - start + first)))
    # One row for each partition and shard, and one more for each transfer: bounded by partitions plus shards.
    steps = local_rows(spark, pieces, "_old int, _p int, _lo long, _hi long, shard int, _base long")
    meets = (F.col("old_shard") == F.col("_old")) & (F.col("_part") == F.col("_p")) & (F.col("_row") >= F.col("_lo")) & (F.col("_row") < F.col("_hi"))
    return placed.join(F.broadcast(steps), meets).select("doc_id", "size", "text_crc32", "old_shard", "shard", (F.col("_row") + F.col("_base")).alias("slot"), *(["carried"] if carry else []))


def rewrite_affected(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> list[int]:
    """Write the shards whose rows change, each to ``path/shard=N``, and return their numbers.

    A shard is affected if a row enters or leaves it; the others' files stay as they are. Every row is written once: from the layout
    if that carries the rows, else by its id, and then null or repeated ids raise ValueError before anything is written. Only affected
    folders are replaced (dynamic partition overwrite); those of shards that are left without rows are removed after that.
    """
    if clash := {"shard", "slot"} & {c.lower() for c in docs.columns}:
        raise ValueError(f"docs has columns that the layout adds: {sorted(clash)}")
    moves = placed.where("shard <> old_shard")
    touched = sorted({r[0] for r in moves.select(F.explode(F.array("old_shard", "shard"))).distinct().collect()})
    going = placed.where(F.col("shard").isin(touched))
    if "carried" in placed.columns:
        rows = going.select("carried.*", "shard", "slot")
    elif docs.groupBy(F.col(id_col).alias("_id")).count().where("count > 1 or _id is null").isEmpty():
        rows = docs.join(going.select(F.col("doc_id").alias("_id"), "shard", "slot"), F.col(id_col) == F.col("_id")).drop("_id")
    else:
        raise ValueError("ids are null or repeated: the layout must carry the rows")
    parts = max(1, len(touched))
    (rows.repartitionByRange(max(parts, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "shard", "slot").sortWithinPartitions("shard", "slot")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path))
    held = {r[0] for r in going.select("shard").distinct().collect()}
    for shard in set(touched) - held:
        files.delete(docs.sparkSession, f"{path}/shard={shard}")
    return touched


def uneven_shards(doc_id: str, shards: int = OLD_SHARDS) -> Column:
    """Old shards by the id's checksum, shard k holding k + 1 parts of all: the last ones are over any even capacity, the first ones under it."""
    return F.floor((F.sqrt(8 * fold(doc_id, shards * (shards + 1) // 2) + 1) - 1) / 2).cast("int")


def op3_min_cost_flow_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents from 44 uneven old shards (by the id's checksum) to 40 even ones; the last four close."""
    placed = layout(table(spark, sf_dir, "documents"), uneven_shards("doc_id"), NEW_SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard")


QUERIES = {"op3_min_cost_flow_resharding": op3_min_cost_flow_resharding}
ORACLES: dict[str, str] = {}

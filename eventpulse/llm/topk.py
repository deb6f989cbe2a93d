"""Exact top-k search among binary codes by incremental multi-index hashing.

An embedding's code has one bit for each dimension: 1 where the value is above zero. Codes are cut into segments of about log2(n) bits, n being the number of distinct
codes, and each distinct code is posted under (segment, value) in a distributed table. In round r every query that is not done sends probes: its own value in each segment with r bits flipped.
Probes meet postings in one equi-join, and what meets is verified by its whole distance. A code that several probes meet counts only
where its segments differ least, and of those in the first one, so no candidate is taken twice. After round r every code at a distance below (r + 1) times the number of
segments has been met, so a query is done when its kth verified distance is below that. Candidates farther than the kth of the rounds before are dropped at once.

Radii grow while a round's probes are fewer than the codes; a query that needs more than that would look at everything, and is finished by a search over
blocks of codes, each with an index of its own that grows radii segment by segment in the same way. Blocks and queries have bounded sizes and a block's results are at most k + 1 for each query.

Equal codes are one entry that carries its least ids: with ties broken by id, no more than k + 1 of them can be in any answer, so a
group with a third of all rows costs no more than a single one. Equal queries are searched once.

Defined results: rows without an id, without an embedding, or with another number of dimensions are left out; null and NaN values have
bit 0. A table that has embeddings but none of 64 dimensions raises ValueError. A row is no answer to itself: other rows of the same id aren't either. Repeated ids count once. With
fewer than k other rows all are answers. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table

BITS, SEGMENTS, K = 64, 4, 10
WIDTH = BITS // SEGMENTS
CODE_BLOCK, QUERY_BLOCK = 1 << 15, 1 << 10
LEAST_WIDTH, MOST_WIDTH = 8, 32


def code_of(embedding: Column, bits: int = BITS) -> Column:
    """The signed 64-bit number of the signs; null for another number of dimensions."""
    set_bit = lambda x, i: F.when(F.coalesce((x > 0) & ~F.isnan(x), F.lit(False)), F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))
    return F.when(F.size(embedding) == bits, F.aggregate(F.transform(embedding, set_bit), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b)))


@cache
def _masks(radius: int, width: int = WIDTH) -> np.ndarray:
    """All numbers of ``width`` bits with ``radius`` bits set."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(width), radius)], np.int64)


class Index:
    """Codes posted under the values of their segments."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes, self.order, self.starts = codes, [], []
        for s in range(SEGMENTS):
            values = self.segment(codes, s)
            self.order.append(np.argsort(values, kind="stable"))
            self.starts.append(np.searchsorted(values[self.order[s]], np.arange((1 << WIDTH) + 1)))

    @staticmethod
    def segment(codes: np.ndarray, s: int) -> np.ndarray:
        return ((codes >> np.uint64(s * WIDTH)) & np.uint64((1 << WIDTH) - 1)).astype(np.int64)

    def lookup(self, s: int, values: np.ndarray) -> np.ndarray:
        """Positions of the codes that have one of these values in a segment."""
        first, last = self.starts[s][values], self.starts[s][values + 1]
        some = last > first
        first, size = first[some], (last - first)[some]
        if not len(size):
            return np.empty(0, np.int64)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
        return self.order[s][at]

    def nearest(self, query: int, weight: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and distances of all codes no farther than the distance within which at least ``need`` of weight lie."""
        q, met = np.uint64(query), np.zeros(len(self.codes), bool)
        own = [int(self.segment(np.array([q], np.uint64), s)[0]) for s in range(SEGMENTS)]
        found, far = [], np.zeros(BITS + 1, np.int64)
        for step in range(SEGMENTS * (WIDTH + 1)):
            radius, s = divmod(step, SEGMENTS)
            at = self.lookup(s, own[s] ^ _masks(radius))
            at = at[~met[at]]
            if len(at):
                met[at] = True
                distance = np.bitwise_count(self.codes[at] ^ q).astype(np.int64)
                far += np.bincount(distance, weights=weight[at], minlength=BITS + 1).astype(np.int64)
                found.append((at, distance))
            covered = step + 1  # every code at a smaller distance has been met
            within = np.cumsum(far)
            if within[min(covered - 1, BITS)] >= need or met.all():
                break
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at, distance = (np.concatenate(x) for x in zip(*found))
        kth = int(np.argmax(within >= need)) if within[-1] >= need else BITS
        keep = distance <= kth
        return at[keep], distance[keep]


def _search(left: pd.DataFrame, right: pd.DataFrame, k: int) -> pd.DataFrame:
    """Best k + 1 (distance, id) of a cell's codes for each of its queries."""
    if not len(left) or not len(right):
        return pd.DataFrame({"query": [], "distance": [], "vec_id": []}).astype("int64")
    ids = left["ids"].tolist()
    index, weight = Index(left["code"].to_numpy().view(np.uint64)), np.array([len(x) for x in ids])
    queries, distances, answers = [], [], []
    for signed in right["query"].to_numpy():
        at, distance = index.nearest(int(np.int64(signed).view(np.uint64)), weight, k + 1)
        best = sorted((d, i) for p, d in zip(at.tolist(), distance.tolist()) for i in ids[p])[: k + 1]
        queries += [signed] * len(best)
        distances += [d for d, _ in best]
        answers += [i for _, i in best]
    return pd.DataFrame({"query": np.array(queries, np.int64), "distance": np.array(distances, np.int64), "vec_id": np.array(answers, np.int64)})


def _least(rows: DataFrame, by: list[str], order: list[str], count: int) -> DataFrame:
    """The first ``count`` rows of each key; each task keeps that many before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("_n", rank).where(F.col("_n") <= count)


def segments_of(codes: int) -> list[tuple[int, int]]:
    """(first bit, width) of the segments, for so many distinct codes."""
    width = min(MOST_WIDTH, max(LEAST_WIDTH, round(float(np.log2(max(codes, 2))))))
    count = max(1, round(BITS / width))
    ends = [BITS * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:])]


def _value(code: Column, start: int, width: int) -> Column:
    return F.shiftrightunsigned(code, start).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _probes(pending: DataFrame, cuts: list[tuple[int, int]], radius: int) -> DataFrame:
    """(query, kth, segment, value) of all values at this radius from each query's own."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for k in range(0, part.num_rows, 256):
                some = part.slice(k, 256)
                query = some.column(0).to_numpy()
                for s, (start, width) in enumerate(cuts):
                    masks = _masks(radius, width)
                    if len(masks):
                        own = ((query.view(np.uint64) >> np.uint64(start)) & np.uint64((1 << width) - 1)).astype(np.int64)
                        every = np.repeat(np.arange(len(query)), len(masks))
                        yield pa.record_batch({"query": some.column(0).take(pa.array(every)), "kth": some.column(1).take(pa.array(every)), "segment": pa.array(np.full(len(every), s, np.int32)), "value": pa.array((own[:, None] ^ masks).ravel())})

    return pending.select("query", "kth").mapInArrow(batches, "query long, kth long, segment int, value long")


def _meeting(probes: DataFrame, posted: DataFrame) -> DataFrame:
    """A merge join, always: probes are many times the queries that they are made from, by whose size the planner would broadcast them."""
    return probes.hint("merge").join(posted, ["segment", "value"])


def _grown(entries: DataFrame, asked: DataFrame, n_codes: int, k: int) -> tuple[DataFrame, DataFrame]:
    """Rounds of growing radii over the distributed postings: (query, distance, vec_id) of the best so far, and the queries that are not done."""
    cuts = segments_of(n_codes)
    posted = entries.select("code", "ids", F.posexplode(F.array(*(_value(F.col("code"), a, w) for a, w in cuts))).alias("segment", "value"))
    posted = materialize(posted.repartition("segment", "value"), "code-postings")
    best = asked.select("query", F.lit(0).cast("long").alias("distance"), F.lit(0).cast("long").alias("vec_id")).where("false")
    pending = asked.select("query", F.lit(BITS).cast("long").alias("kth"))
    for radius in range(max(w for _, w in cuts) + 1):
        if sum(comb(w, radius) for _, w in cuts) > n_codes:
            break
        apart = F.col("code").bitwiseXOR(F.col("query"))
        each = [F.bit_count(_value(apart, a, w)) for a, w in cuts]
        first = F.array_position(F.array(*each), F.lit(radius)) - 1
        met = _meeting(_probes(pending, cuts, radius), posted)
        met = met.where((F.least(*each, F.lit(BITS)) == radius) & (first == F.col("segment"))).select("query", "kth", F.bit_count(apart).cast("long").alias("distance"), "ids").where("distance <= kth")
        met = met.select("query", "distance", F.explode("ids").alias("vec_id"))
        best = materialize(_least(best.union(met), ["query"], ["distance", "vec_id"], k + 1).select("query", "distance", "vec_id"), "code-best")
        reach = best.groupBy("query").agg(F.count("*").alias("n"), F.max("distance").alias("far"))
        state = pending.join(reach, "query", "left").select("query", F.when(F.col("n") > k, F.col("far")).otherwise(F.lit(BITS).cast("long")).alias("kth"), (F.coalesce("n", F.lit(0)) > k).alias("full"))
        # Every code nearer than this has been met; ties at the kth distance must have been met too.
        pending = materialize(state.where(~F.col("full") | (F.col("kth") >= (radius + 1) * len(cuts))).select("query", "kth"), "code-pending")
        if pending.isEmpty():
            break
    return best, pending


def nearest(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", embedding_col: str = "embedding", code_block: int = CODE_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, distance): the k nearest other rows of each row where ``is_query`` holds, ties by id."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), code_of(F.col(embedding_col)).alias("code"), F.coalesce(is_query, F.lit(False)).alias("asks")).where("vec_id is not null and code is not null")
    rows = materialize(rows.groupBy("vec_id", "code").agg(F.max("asks").alias("asks")), "codes")
    entries = _least(rows.select("vec_id", "code"), ["code"], ["vec_id"], k + 1).groupBy("code").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    entries = materialize(entries, "code-entries")
    asked = materialize(rows.where("asks").select(F.col("code").alias("query")).distinct(), "query-codes")
    total = entries.count()
    if not total and (odd := vectors.where((F.size(embedding_col) > 0) & (F.size(embedding_col) != BITS)).select(F.size(embedding_col)).first()):
        raise ValueError(f"embeddings of {odd[0]} dimensions: codes have {BITS} bits")
    best, pending = _grown(entries, asked, total, k)
    if not pending.isEmpty():
        n_codes, n_queries = -(-total // code_block), -(-pending.count() // query_block)
        dealt = lambda c, n, salt: F.pmod(F.xxhash64(c, F.lit(salt)), F.lit(max(1, n))).cast("int")
        each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(max(1, n) - 1)))
        left = entries.select("code", "ids", dealt("code", n_codes, "codes").alias("cell_code"), each(n_queries).alias("cell_query"))
        right = pending.select("query", dealt("query", n_queries, "queries").alias("cell_query"), each(n_codes).alias("cell_code"))
        keys = ["cell_code", "cell_query"]
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(lambda a, b: _search(a, b, k), "query long, distance long, vec_id long")
        found = _least(found, ["query"], ["distance", "vec_id"], k + 1).select("query", "distance", "vec_id")
        best = best.join(pending.select("query"), "query", "left_anti").select("query", "distance", "vec_id").union(found)
    best = best.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("distance", "vec_id"))).alias("best"))
    queries = rows.where("asks").select(F.col("vec_id").alias("query_id"), F.col("code").alias("query"))
    answers = queries.join(best, "query").select("query_id", F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("best"))
    answers = answers.select("query_id", F.posexplode("best").alias("rank", "b"))
    return answers.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.distance").cast("int").alias("distance"))


def op5_multi_index_hashing_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest other codes of every vector whose id is divisible by 20."""
    return nearest(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(20)) == 0)


_ORACLE = f"""
with c as (select distinct vec_id, list_transform(embedding, lambda x: coalesce(x > 0 and not isnan(x), false)) bits from embeddings where vec_id is not null and len(embedding) = {BITS}),
d as (select q.vec_id query_id, c.vec_id, list_sum(list_transform(list_zip(q.bits, c.bits), lambda z: (z[1] <> z[2])::int)) distance from c q join c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id),
r as (select query_id, row_number() over (partition by query_id order by distance, vec_id)::int as rank, vec_id, distance::int distance from d)
select * from r where rank <= {K}"""

QUERIES = {"op5_multi_index_hashing_topk": op5_multi_index_hashing_topk}
ORACLES = {"op5_multi_index_hashing_topk": _ORACLE}

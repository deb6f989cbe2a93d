"""Connected components by alternating large-star and small-star steps, all as DataFrame joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: As many links as a task puts together before the steps begin (16 MB).
CHUNK = 1 << 20


def forest(a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions a, b) reduced to one link of each node to the smallest id of its group here."""
    order = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    x, y, label = rank[a], rank[b], np.arange(len(ids))
    while len(x):
        low = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        label = label[label]
        if np.array_equal(before, label) and np.array_equal(label[x], label[y]):
            break
    moved = np.flatnonzero(label != np.arange(len(ids)))
    return ids[order[moved]], ids[order[label[moved]]]


def _forests(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a task as forests of at most ``CHUNK`` links each."""

    def reduced(held: list[np.ndarray]) -> np.ndarray:
        nodes, at = np.unique(np.concatenate(held), return_inverse=True)
        at = at.reshape(-1, 2)
        return np.stack(forest(at[:, 0], at[:, 1], nodes), axis=1)

    held, size = [np.empty((0, 2), np.int64)], 0
    for part in parts:
        held.append(np.stack([part.column(k).to_numpy() for k in (0, 1)], axis=1))
        size += part.num_rows
        if size >= 2 * CHUNK:
            held = [reduced(held)]
            size = len(held[0])
            if size >= CHUNK:
                yield pa.record_batch({"u": pa.array(held[0][:, 0]), "v": pa.array(held[0][:, 1])})
                held, size = [np.empty((0, 2), np.int64)], 0
    left = reduced(held)
    yield pa.record_batch({"u": pa.array(left[:, 0]), "v": pa.array(left[:, 1])})


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one link at most to a smaller one, and none that is linked to is linked further."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(edges.select("v", F.lit(0), F.lit(1)))
    sums = ends.groupBy("node").agg(F.sum("down").alias("down"), F.sum("up").alias("up"))
    return sums.where("down > 1 or (down > 0 and up > 0)").isEmpty()


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """From rows (u, v) to one row (u, v) per node that isn't the smallest of its component: v is that smallest node.

    Each step replaces a node's links by links to the smallest neighbour. Only minima are
    gathered by key (with map-side combining), so a hub's links stay spread over tasks; the two
    joins are plain equi-joins that adaptive execution can split. Each round is written to the
    shared folder; the rounds end when all that is left is stars. Before them each task reduces chunks of its links to forests of stars, which is all there is to do for as many links as a chunk holds. Self-links, repeated links and an empty input are allowed; null ends are dropped.
    """
    known = edges.where("u is not null and v is not null and u <> v")
    known = materialize(known.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), label)
    tasks = -(-known.count() // CHUNK)
    known = materialize(known.coalesce(max(1, tasks)).mapInArrow(_forests, "u long, v long"), label)
    if tasks < 2:  # one chunk had them all
        return known
    while not _stars(known):
        both = known.union(known.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") > F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"))
        # A node keeps the link to its minimum, and hands that minimum to its other smaller neighbours.
        known = materialize(small.union(least.select("u", F.col("m").alias("v"))).distinct(), label)
    return known

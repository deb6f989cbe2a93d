"""Linking what meets in lists: which members of inverted lists are as similar as asked, as connected components, without all pairs of a list.

A list's pairs are looked at in stars: a few members are centres, and each is compared with the members of the list that aren't in its component yet. After a round the components
are put together, and lists whose members are all in one component are done. What a pair's sketches rule out is refused in the join that would make the pair; only the rest become rows, and their
sets are fetched, once for a pair. In the first
round a list has one centre, its least member by hash, so lists that hold the same texts share their centre and a pair is checked once. In later rounds only members outside the list's largest component become centres: ``_FEW``
of them, then all that are left. Then every pair of the list is either refused, checked or inside a component. No link between different texts is lost, whatever the lists, and a list whose members
link costs about as many checks as it has members.

Lists may come in tiers, the most promising first: of those but the last only the first stars are looked at, which puts most of a group together before the longer lists are opened.

Checks ship a text's set once to each centre that it is compared with; a centre's set goes once to every ``_STAR`` of its members, so that a star of any size is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, materialize
from .components import connected_components

_STAR, _FEW = 512, 16


def _order(node: str = "node") -> Column:
    return F.struct(F.xxhash64(node), F.col(node))


def checked_on_sets(pairs: DataFrame, sets: DataFrame, alike: Callable[[int, int, int], bool]) -> DataFrame:
    """The pairs (u, v) whose sets are ``alike(common, size of u's, size of v's)``. ``sets``: (node, hashes), the sorted 64-bit hashes of a set as bytes."""
    stars = pairs.groupBy("u").agg((F.ceil(F.count("*") / _STAR)).cast("int").alias("salts"))
    rays = pairs.join(stars, "u").join(sets, F.col("v") == F.col("node")).select("u", F.pmod(F.xxhash64("v"), "salts").cast("int").alias("salt"), "v", "hashes")
    heads = stars.join(sets, F.col("u") == F.col("node")).select("u", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("long").alias("v"), "hashes")

    def check(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre: np.ndarray | None = None
        for part in parts:
            us, vs = [], []
            for u, v, data in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2)):
                own = np.frombuffer(data.as_buffer(), np.uint64)
                if v is None:
                    centre = own.copy()  # the batch goes
                    continue
                at = np.searchsorted(centre, own)
                at[at == len(centre)] = 0
                common = int(np.count_nonzero(centre[at] == own)) if len(centre) else 0
                if alike(common, len(centre), len(own)):
                    us.append(u)
                    vs.append(v)
            yield pa.record_batch({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})

    both = heads.union(rays).repartition("u", "salt").sortWithinPartitions("u", "salt", F.col("v").asc_nulls_first())
    return both.select("u", "v", "hashes").mapInArrow(check, "u long, v long")


def linked(tiers: Sequence[DataFrame], check: Callable[[DataFrame], DataFrame], more: Sequence[str] = (), can: Callable[[str, str], Column] | None = None, told: dict | None = None) -> DataFrame:
    """(u, v) for every node that isn't the smallest of its component: v is that smallest node.

    ``tiers``: rows (key, node, *more), node a long. ``check`` keeps those of pairs (u, v) that are links. ``can(a, b)`` tells from the columns of ``more``, with the prefixes
    a and b, whether a pair may be a link; it must refuse none. ``told`` is given the numbers of checked pairs and of rounds.
    """
    spark = tiers[0].sparkSession
    roots = spark.createDataFrame([], "u long, v long")
    tested: DataFrame | None = None
    n_checked = n_rounds = 0
    spent: list[DataFrame] = []  # members and centres of the round before, which go once this round's members are written
    for nth, lists in enumerate(tiers):
        last, stars, state = nth == len(tiers) - 1, 1, lists
        while True:
            members = state.join(roots.select(F.col("u").alias("node"), F.col("v").alias("_root")), "node", "left").select("key", "node", *more, F.coalesce("_root", "node").alias("root"))
            if stars == 1:
                open_lists = members.groupBy("key").agg(F.min("root").alias("_a"), F.max("root").alias("_b")).where("_a <> _b").select("key", F.col("_a").alias("big"))
            else:
                tally = members.groupBy("key", "root").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("big"), F.count("*").alias("roots"))
                open_lists = tally.where("roots > 1").select("key", "big")
            members = materialize(members.join(open_lists, "key"), "link-members")
            drop(*spent)
            spent = [members]
            if members.isEmpty():
                break
            n_rounds += 1
            mine = ["node", "root", *more]
            if stars == 1:
                centres = members.groupBy("key").agg(F.min_by(F.struct(*mine), _order()).alias("c")).select("key", *(F.col(f"c.{c}").alias(f"c_{c}") for c in mine))
            else:
                centres = members.where("root <> big")
                if stars:
                    centres = centres.withColumn("_nth", F.row_number().over(Window.partitionBy("key").orderBy(_order()))).where(F.col("_nth") <= stars)
                centres = centres.select("key", *(F.col(c).alias(f"c_{c}") for c in mine))
            centres = materialize(centres, "link-centres")
            spent.append(centres)
            met = members.join(centres, "key").where(F.col("root") != F.col("c_root"))
            if can:
                met = met.where(can("c_", ""))
            turned = _order("node") < _order("c_node")  # the centre of a pair is the lesser of the two, so that lists agree on it
            pairs = met.select(F.when(turned, F.col("node")).otherwise(F.col("c_node")).alias("u"), F.when(turned, F.col("c_node")).otherwise(F.col("node")).alias("v")).distinct()
            pairs = materialize(pairs if tested is None else pairs.join(tested, ["u", "v"], "left_anti"), "link-pairs")
            tested = pairs if tested is None else tested.union(pairs)
            n_checked += pairs.count() if told is not None else 0
            if not pairs.isEmpty():
                found = materialize(check(pairs), "link-found")
                if not found.isEmpty():
                    roots = connected_components(roots.union(found), "link-roots")
            if not last or not stars:
                break
            state, stars = members.select("key", "node", *more), _FEW if stars == 1 else 0
    drop(*spent)
    if told is not None:
        told |= {"checked": n_checked, "rounds": n_rounds}
    return roots


def several(postings: DataFrame) -> DataFrame:
    """The postings of lists that more than one node is in."""
    counts = postings.groupBy("key").agg(F.min("node").alias("_a"), F.max("node").alias("_b")).where("_a <> _b").select("key")
    return postings.join(counts, "key")


def one_of_each(lists: DataFrame, at: str = "at") -> DataFrame:
    """Of lists with the same members only the one in which they stand first: near copies share many shingles, and so many lists.

    Places follow one order for all texts, so of two such lists one has the smaller place for every member, and what a place leaves room for in the other it leaves room for in this one: no pair is lost.
    """
    same = [F.count("*").alias("_size"), *(F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"_digest{k}") for k in range(2))]
    each = lists.groupBy("key").agg(*same, F.sum(at).alias("_places"))
    first = each.groupBy("_size", "_digest0", "_digest1").agg(F.min_by("key", F.struct("_places", "key")).alias("key"))
    return lists.join(first.select("key"), "key", "left_semi")

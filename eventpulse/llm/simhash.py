"""SimHash near-duplicates: 64-bit fingerprints, a byte-position inverted index with count filtering, components.

Two fingerprints that differ in at most 3 bits differ in at most 3 of their 8 bytes, so they share
at least 5 positional bytes. The index posts each distinct fingerprint under 14 combinations of four
byte positions: the planes of the affine space of 8 points, a Steiner system S(3,4,8), of which one
always avoids any 3 positions. Every pair to be found therefore meets in a list, and a list's
entries agree in 32 bits, so lists stay short at any corpus size; lists of single bytes would hold a 256th of the corpus each. What this changes in the method: the tally runs
over pairs that share four bytes already, and drops those that share no fifth. Within a list the shared
positional bytes of each pair are tallied, pairs below the guaranteed 5 are dropped, and the rest
verified bit by bit. A list leaves only a spanning forest of its links, never all pairs of a group.

Defined results: null and empty text, and text without words, have fingerprint zero and link like
any other. Fewer than three words make one shingle. Repeated rows share a fingerprint and hence a
component. A row without doc_id takes the component of rows with its fingerprint, or null; it joins
no others. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ASCII_LOWER, materialize, table
from .components import connected_components, forest

SHINGLE, SEED, MAX_BITS = 3, 42, 3
MIN_SHARED = 8 - MAX_BITS
#: Byte positions of the index lists: all 4-subsets of 0..7 whose exclusive-or is zero.
PLANES = [c for c in combinations(range(8), 4) if c[0] ^ c[1] ^ c[2] ^ c[3] == 0]
#: A list with more distinct fingerprints is split by a fifth byte, which any pair to be found also shares.
LONG_LIST = 1 << 16
_CHUNK = 1 << 15


def _mask(positions: tuple[int, ...]) -> int:
    """The bits of these bytes as a signed 64-bit number."""
    value = sum(0xFF << (8 * p) for p in positions)
    return value - (1 << 64) if value >> 63 else value


def fingerprint_of(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of one whole UTF-8 text as a signed 64-bit number."""
    words = (text or b"").translate(ASCII_LOWER).split()
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    digest, set_bits = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, n, _CHUNK):
        hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts[k : k + _CHUNK], stops[k : k + _CHUNK])], np.uint64)
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, text_key) for every row; fp is a signed 64-bit number, text_key a hash of the text."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = part.column(1).cast(pa.large_binary() if pa.types.is_large_string(part.column(1).type) else pa.binary())
            yield pa.record_batch({"doc_id": part.column(0), "fp": pa.array((fingerprint_of(t.as_py()) for t in texts), pa.int64()), "text_key": part.column(2)})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), _text_key(text_col).alias("text_key"))
    return rows.mapInArrow(batches, "doc_id long, fp long, text_key long")


def _text_key(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def _shared_bytes_differ(x: np.ndarray) -> np.ndarray:
    """How many of 8 bytes are not zero, for each 64-bit number."""
    x = x | (x >> np.uint64(4))
    x |= x >> np.uint64(2)
    x |= x >> np.uint64(1)
    return np.bitwise_count(x & np.uint64(0x0101010101010101))


def _links(x: np.ndarray, max_bits: int) -> np.ndarray:
    """Count filter, then verification, of exclusive-ors of pairs."""
    keep = _shared_bytes_differ(x) <= 8 - MIN_SHARED
    keep[keep] = np.bitwise_count(x[keep]) <= max_bits
    return keep


def links(a: Column, b: Column, max_bits: int = MAX_BITS) -> Column:
    """The same for two columns of fingerprints: the tally of shared positional bytes, then the bits."""
    x = a.bitwiseXOR(b)
    shared = sum((F.when(x.bitwiseAND(F.lit(_mask((k,)))) == 0, 1).otherwise(0) for k in range(8)), F.lit(0))
    return (shared >= MIN_SHARED) & (F.bit_count(x) <= max_bits)


def _pairs_of(starts: np.ndarray, sizes: np.ndarray, fps: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of linked pairs within lists; a list is fps[start:start+size]."""
    short = sizes <= 64
    left, room = np.repeat(starts[short], sizes[short]), np.repeat(sizes[short], sizes[short])
    at = np.arange(len(left)) - np.repeat(np.cumsum(sizes[short]) - sizes[short], sizes[short])
    for step in range(1, int(sizes[short].max(initial=0))):
        fits = at + step < room
        left, room, at = left[fits], room[fits], at[fits]
        i = left + at
        hit = i[_links(fps[i] ^ fps[i + step], max_bits)]
        if len(hit):
            yield hit, hit + step
    for start, size in zip(starts[~short].tolist(), sizes[~short].tolist()):
        own = fps[start : start + size]
        rows = max(1, (1 << 20) // size)
        for k in range(0, size, rows):
            i, j = np.nonzero(_links(own[k : k + rows, None] ^ own[None, k:], max_bits))
            ahead = j > i
            if ahead.any():
                yield start + k + i[ahead], start + k + j[ahead]


def _find(batches: Iterator[pd.DataFrame], max_bits: int) -> Iterator[pd.DataFrame]:
    """Lists arrive sorted by their key; a list that straddles batches is put together first."""

    def work(part: pd.DataFrame) -> pd.DataFrame:
        key, combo = part["key"].to_numpy(), part["combo"].to_numpy()
        starts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]) | (combo[1:] != combo[:-1])) + 1])
        sizes = np.diff(np.append(starts, len(key)))
        fps, ids = part["fp"].to_numpy().view(np.uint64), part["first"].to_numpy()
        starts, sizes = starts[sizes > 1], sizes[sizes > 1]
        u, v = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for a, b in _pairs_of(starts, sizes, fps, max_bits):
            nodes, at = np.unique(np.concatenate([ids[a], ids[b]]), return_inverse=True)
            x, y = forest(at[: len(a)], at[len(a) :], nodes)
            u.append(x)
            v.append(y)
        u, v = np.concatenate(u), np.concatenate(v)
        nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        u, v = forest(at[: len(u)], at[len(u) :], nodes)
        return pd.DataFrame({"u": u, "v": v})

    held: list[pd.DataFrame] = []
    for part in batches:
        if not len(part):
            continue
        last = (part["key"] == part["key"].iloc[-1]) & (part["combo"] == part["combo"].iloc[-1])
        cut = int(np.flatnonzero(~last.to_numpy())[-1]) + 1 if not last.all() else 0
        if cut or (held and (held[-1]["key"].iloc[-1] != part["key"].iloc[0] or held[-1]["combo"].iloc[-1] != part["combo"].iloc[0])):
            held.append(part.iloc[:cut])
            yield work(pd.concat(held))
            held = []
        held.append(part.iloc[cut:])
    if held:
        yield work(pd.concat(held))


def index(distinct: DataFrame, long_list: int = LONG_LIST) -> DataFrame:
    """Postings (combo, key, fp, first) of distinct fingerprints; lists over ``long_list`` are split by a fifth byte."""

    def posted(rows: DataFrame, combos: list[tuple[int, int]]) -> DataFrame:
        each = F.explode(F.array(*(F.struct(F.lit(c).alias("combo"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for c, m in combos)))
        return rows.select("fp", "first", each.alias("at")).select("at.combo", "at.key", "fp", "first")

    lists = posted(distinct, [(k, _mask(p)) for k, p in enumerate(PLANES)])
    long = materialize(lists.groupBy("combo", "key").count().where(F.col("count") > long_list).select("combo", "key"), "long-lists")
    if long.isEmpty():
        return lists
    split = lists.join(long, ["combo", "key"], "left_semi")
    parts = [
        posted(split.where(F.col("combo") == k).select("fp", "first"), [(100 + 8 * k + q, _mask((*p, q))) for q in range(8) if q not in p])
        for k, p in enumerate(PLANES)
    ]
    out = lists.join(long, ["combo", "key"], "left_anti")
    for part in parts:
        out = out.union(part)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, long_list: int = LONG_LIST) -> DataFrame:
    """One row (doc_id, fp, component_id, text_key) per document; component_id is the smallest doc_id reachable over links."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the index guarantees links of up to {MAX_BITS} bits, not {max_bits}")
    own = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = own.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("first"))
    distinct = materialize(distinct, "distinct-fingerprints")
    lists = index(distinct, long_list)
    found = lists.repartition(_partitions(docs.sparkSession), "combo", "key").sortWithinPartitions("combo", "key")
    links = found.mapInPandas(lambda parts: _find(parts, max_bits), "u long, v long")
    roots = connected_components(links, "simhash-links")
    of = distinct.join(roots, distinct["first"] == roots["u"], "left").select(distinct["fp"].alias("_fp"), F.coalesce("v", "first").alias("component_id"))
    return own.join(of, own["fp"] == of["_fp"], "left").select("doc_id", "fp", "component_id", "text_key")


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op9_simhash_near_dedup": op9_simhash_near_dedup}
ORACLES: dict[str, str] = {}

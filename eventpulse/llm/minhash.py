"""MinHash near-duplicates: one-permutation hashing with optimal densification, banded buckets, star-shaped candidate edges, checks on full sets.

One hash of each shingle does for the whole sketch: its first bits say the bin, and a bin keeps its least hash. An empty bin takes over the value of the first bin with one in an order of bins of its own (the same for all documents), so that
any two sketches agree in a bin with the probability of their sets' Jaccard similarity, however small the sets. ``BINS`` bins make ``BANDS`` bands of ``ROWS`` rows; documents that agree in all rows of a band
meet in a bucket. At a similarity of 0.8 a pair fails to meet with probability (1 - 0.8^7)^73 = 3e-8, less above; at 0.5 it meets in half a bucket on average.

Buckets of 14 rows, made of neighbouring bands, come first: what meets there is most likely alike. Within a bucket candidate edges are stars (``linking``); each edge is checked on the full sets, and edges that fail are followed by
further stars until every pair of the bucket is checked or connected otherwise, so no link that meets in a bucket is lost. Equal sets are one node, so copies never meet in pairs. One bit of each bin, drawn by the bin, the
sizes of the sets and their odd sketches rule out pairs as lists are joined: at 0.8 a pair differs in 51.2 of 512 bits on average, and is refused above 91 (six standard deviations); an odd sketch
bounds from below in how many elements two sets differ, which is sharp for sets of a few hundred.

Defined results: fewer words than a shingle has make one shingle. Null text and text without words have an empty set, which links with nothing: the document is its own component. A row without id takes the component of
rows with its set, or null, isn't kept, and links no others. Repeated rows share a set. Extra columns are ignored. An empty table gives no rows. Sets are of 64-bit hashes of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import linking
from .common import materialize, table
from .shingles import odd_allows, odd_sketch, sets_of, shingles_of, slices, text_key, words_of

SHINGLE, PERCENT = 2, 80
BINS, ROWS = 512, 7
BANDS = BINS // ROWS
_NEAR = 32


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: For each bin the order in which an empty one asks the others, and an odd number that draws its bit.
_ASKED = np.argsort(_mixed(np.arange(1, BINS * BINS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(BINS, BINS), axis=1)
_ODD = _mixed(np.arange(1, BINS + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)
_BAND = _mixed(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x8CB92BA72F3D8DD7))


def sketch_of(hashes: np.ndarray) -> np.ndarray:
    """The densified sketch of a non-empty set of hashes: ``BINS`` values."""
    hashes = np.sort(_mixed(hashes))
    bins = (hashes >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    firsts = np.flatnonzero(np.diff(bins, prepend=-1))
    sketch, full = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    sketch[bins[firsts]], full[bins[firsts]] = hashes[firsts], True
    empty = np.flatnonzero(~full)
    for width in (_NEAR, BINS):  # most find one among the first that they ask
        asked = _ASKED[empty, :width]
        found = full[asked]
        some = found.any(axis=1)
        at = found[some].argmax(axis=1)
        sketch[empty[some]] = sketch[asked[some][np.arange(len(at)), at]]
        empty = empty[~some]
        if not len(empty):
            break
    return sketch


def bands_of(sketch: np.ndarray) -> np.ndarray:
    """One key for each band of ``ROWS`` values."""
    keys = _BAND.copy()
    for column in sketch[: BANDS * ROWS].reshape(-1, ROWS).T:
        keys = _mixed(keys ^ column) * np.uint64(0x9E3779B97F4A7C15)
    return keys


def bits_of(sketch: np.ndarray) -> np.ndarray:
    """One bit for each bin, 64 to a number."""
    return np.packbits((sketch * _ODD) >> np.uint64(63) == 1).view(np.uint64)


def bits_allow(a: str, b: str, similarity: float) -> Column:
    """Whether two columns of bits differ in no more than a pair of the similarity does, six standard deviations allowed for."""
    p = (1 - similarity) / 2
    differ = sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(BINS // 64)), F.lit(0))
    return differ <= int(BINS * p + 6 * (BINS * p * (1 - p)) ** 0.5)


def profiles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, n, a, b, bits, odd, bands) for every row: n counts the set, a and b are its digest, odd is its odd sketch, bands are the keys of its buckets."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            n, digests, bits, odd, bands = [], [], [], [], []
            for text in part.column(1):
                hashes = shingles_of(words_of(text.as_py()), shingle)
                n.append(len(hashes))
                digests.append(np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), np.int64))
                sketch = sketch_of(hashes) if len(hashes) else None
                bits.append(bits_of(sketch).view(np.int64) if len(hashes) else np.zeros(BINS // 64, np.int64))
                odd.append(odd_sketch(hashes))
                bands.append(bands_of(sketch).view(np.int64) if len(hashes) else np.empty(0, np.int64))
            digests = np.array(digests).reshape(-1, 2)
            columns = {"n": pa.array(n, pa.int64()), "a": pa.array(digests[:, 0]), "b": pa.array(digests[:, 1]), "bits": pa.array(bits, pa.list_(pa.int64())), "odd": pa.array(odd, pa.list_(pa.int64())), "bands": pa.array(bands, pa.list_(pa.int64()))}
            yield pa.record_batch({"doc_id": part.column(0), "text_key": part.column(2), **columns})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"), text_key(text_col).alias("text_key"))
    return rows.mapInArrow(batches, "doc_id long, text_key long, n long, a long, b long, bits array<long>, odd array<long>, bands array<long>")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT, told: dict | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row; documents are linked where 100 * intersection >= percent * union of their sets."""
    if not 80 <= percent <= 100:
        raise ValueError(f"bands of {ROWS} rows are made for similarities of 80 to 100 percent, not {percent}")
    own = materialize(profiles(docs, id_col, text_col, shingle), "minhash-profiles")
    first = own.where("n > 0 and doc_id is not null").groupBy("a", "b").agg(F.min(F.struct("doc_id", "text_key")).alias("least"), *(F.first(c).alias(c) for c in ("n", "bits", "odd", "bands")))
    nodes = materialize(first.select("a", "b", F.col("least.doc_id").alias("node"), F.col("least.text_key").alias("text_key"), "n", "bits", "odd", "bands"), "minhash-nodes")
    lists = materialize(linking.several(nodes.select(F.explode("bands").alias("key"), "node")), "minhash-lists")
    met = materialize(lists.select("node").distinct(), "minhash-met")
    info = nodes.join(met, "node", "left_semi")
    more = ("n", "bits", "odd")

    def wider(times: int) -> DataFrame:
        """Buckets of so many neighbouring bands."""
        keys = F.array(*(F.xxhash64(F.lit(times), F.lit(k), *(F.col("bands")[k * times + j] for j in range(times))) for k in range(BANDS // times)))
        return materialize(linking.several(info.select(F.explode(keys).alias("key"), "node", *more)), "minhash-wide")

    sets = materialize(sets_of(docs, info.select("node", F.col("node").alias("doc_id"), "text_key"), id_col, text_col, shingle), "minhash-sets")
    tiers = [wider(2), lists.join(info.select("node", *more), "node")]

    def can(a: str, b: str) -> Column:
        n, m = F.col(f"{a}n"), F.col(f"{b}n")
        return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & bits_allow(f"{a}bits", f"{b}bits", percent / 100) & odd_allows(a, b, percent)

    def alike(common: int, n: int, m: int) -> bool:
        return 100 * common >= percent * (n + m - common)

    roots = linking.linked(tiers, lambda pairs: linking.checked_on_sets(pairs, sets, alike), more, can, told)
    of = nodes.join(roots, nodes["node"] == roots["u"], "left").select(F.col("a").alias("_a"), F.col("b").alias("_b"), F.coalesce("v", "node").alias("root"))
    out = own.join(of, (own["a"] == of["_a"]) & (own["b"] == of["_b"]) & (own["n"] > 0), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("root")).otherwise(F.col("doc_id")).alias("component_id"))


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = components(table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


QUERIES = {"op13_minhash_near_dedup": op13_minhash_near_dedup}
ORACLES = {
    "op13_minhash_near_dedup": f"""with recursive words as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') w from documents),
sets as (select doc_id, list_sort(list_distinct(case when len(w) < 2 then w else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end)) s from words),
nodes as (select s, md5(array_to_string(s, chr(10))) k, min(doc_id) node, len(s) n from sets where len(s) > 0 group by s),
posted as (select node, n, unnest(s) g from nodes),
links as (select a.node u, b.node v from posted a join posted b on a.g = b.g and a.node < b.node group by a.node, b.node having 100 * count(*) >= {PERCENT} * (any_value(a.n) + any_value(b.n) - count(*))),
both_ways as (select u, v from links union select v, u from links),
reached as (select node, node other from nodes union select r.node, e.v from reached r join both_ways e on e.u = r.other),
roots as (select node, min(other) root from reached group by node)
select d.doc_id, len(d.s) n_shingles, coalesce(r.root, d.doc_id) component_id, d.doc_id = coalesce(r.root, d.doc_id) kept
from sets d left join nodes n on n.k = md5(array_to_string(d.s, chr(10))) and len(d.s) > 0 left join roots r on r.node = n.node"""
}

"""Near copies by similarity of texts: an inverted index over shingles of five words with position filtering, exact Jaccard checks, components.

This is the wide mode of the near-duplicate operator: texts at Jaccard similarity 0.8 differ in about 10 bits of a 64-bit fingerprint, and no index of byte
positions stays short at that radius. So the operator's own lists come first, fingerprints by byte positions with the tally of shared bytes and the bit count, and for the
pairs beyond 3 bits what is posted is the shingles themselves, and what is counted is how many a pair can still share.

The distinct shingles of a text (its words, ASCII lower case) are put in one order for the whole corpus: the less frequent first. Two texts of n and m shingles at
similarity t share at least a = t / (1 + t) * (n + m) of them, so the first shingle that they share stands among the first n - t * n + 1 of either: only these are
posted, and where they meet at places i and j, at most min(n - i, m - j) can be shared, so a pair for which that is below a is left out. No pair is lost, under any order. The order
by frequency keeps lists short: passages that many documents share stand at the end and are hardly posted. Frequencies are counts by 4 million hash
buckets over all documents; one byte a bucket reaches the driver and the executors, whatever the corpus.

Whatever meets is checked on the whole sets, in stars (``linking``): before the lists come buckets of a MinHash sketch, in which the most alike texts of a group meet, so that most of a group is together
before its lists are opened. Lists with the same members are one, sets are made for the texts of a round's pairs alone, and what a round wrote goes after the next. A group of copies is never compared pair by pair, no list is gathered into one task, and yet every pair that meets is either checked or already linked.

Defined results: fewer than five words make one shingle. Texts without words are copies of each other and of nothing else. Rows without id take part
and stay only where no row of the group has an id. Of rows equal in id and text, one stays, by a digest of all columns. Extra columns are kept by ``keep_one``. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import linking, simhash
from .common import drop, materialize, small_batches
from .minhash import BANDS, bands_of, bits_allow, bits_of, sketch_of
from .shingles import SEED, odd_allows, odd_sketch, sets_of, shingles_of, slices, text_key, words_of

SHINGLE, SIMILARITY = 5, 0.8
BUCKETS, STEPS = 1 << 22, 8
_BLOCK = 1 << 16


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def prefix_of(hashes: np.ndarray, levels: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """The shingles to post, the less frequent first: as many as may come before the first one shared."""
    if not len(hashes):
        return hashes
    order = np.lexsort((hashes, levels[hashes % np.uint64(BUCKETS)]))
    return hashes[order[: len(hashes) - int(np.ceil(similarity * len(hashes) - 1e-9)) + 1]]


def wide_of(sketch: np.ndarray) -> np.ndarray:
    """Keys of buckets in which few but the most alike texts meet: those of two bands of a sketch."""
    bands = bands_of(sketch)
    return bands[: BANDS // 2 * 2 : 2] * np.uint64(0x9E3779B97F4A7C15) ^ bands[1 : BANDS // 2 * 2 : 2]


def frequencies(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE) -> np.ndarray:
    """A level for each hash bucket of shingles: 0, or the binary logarithm, in steps of 1 / ``STEPS``, of how many times the mean its count is."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.uint32)  # a task has fewer shingles than that
        for part in parts:
            for text in part.column(0):
                np.add.at(counts, shingles_of(words_of(text.as_py()), shingle) % np.uint64(BUCKETS), np.uint32(1))
        for k, own in enumerate(counts.reshape(-1, _BLOCK)):
            if own.any():  # a task's counts are mostly small: as bytes they take a byte a bucket
                yield pa.record_batch({"block": pa.array([k], pa.int32()), "counts": pa.array([own.astype(np.min_scalar_type(int(own.max()))).tobytes()], pa.binary())})

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for part in parts:
            for k, data in zip(part.column(0).to_pylist(), part.column(1)):
                own = np.frombuffer(data.as_buffer(), f"u{len(data.as_buffer()) // _BLOCK}")
                sums[k] = sums.get(k, 0) + own.astype(np.int64)
        for k, own in sums.items():
            some = np.flatnonzero(own)
            yield pa.record_batch({"bucket": pa.array((k * _BLOCK + some).astype(np.int32)), "n": pa.array(own[some])})

    rows = docs.select(F.col(text_col).cast("string").cast("binary").alias("text")).mapInArrow(count, "block int, counts binary")
    sums = materialize(rows.repartition("block").mapInArrow(add, "bucket int, n long"), "near-counts")
    mean = max(1.0, (sums.agg(F.sum("n")).first()[0] or 0) / BUCKETS)
    level = F.least(F.floor(STEPS * F.log2(F.col("n") / mean)), F.lit(255)).cast("short")
    often = sums.select("bucket", level.alias("level")).where("level > 0").toArrow()
    levels = np.zeros(BUCKETS, np.uint8)
    levels[often.column("bucket").to_numpy()] = often.column("level").to_numpy()
    return levels


def _word_hash(words: list[bytes]) -> int:
    return xxhash.xxh64_intdigest(b" ".join(words), SEED) - (1 << 63)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"), text_key(text_col).alias("text_key"))


def word_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, node) for every row: node is a hash of the text's words."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield pa.record_batch({"doc_id": part.column(0), "text_key": part.column(2), "node": pa.array((_word_hash(words_of(t.as_py())) for t in part.column(1)), pa.int64())})

    return _texts(docs, id_col, text_col).mapInArrow(batches, "doc_id long, text_key long, node long")


def profiles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, text_key, node, n, fp, keys, wide, bits, odd) for every row: node is a hash of the text's words, n counts its distinct shingles, fp is operator 9's fingerprint, keys are those to post, wide the buckets of its sketch, bits one bit for each of its bins, odd its odd sketch."""
    levels = docs.sparkSession.sparkContext.broadcast(frequencies(docs, text_col, shingle))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        for part in slices(parts):
            node, n, fp, keys, wide, bits, odd = [], [], [], [], [], [], []
            for text in part.column(1):
                text = text.as_py()
                words = words_of(text)
                hashes = shingles_of(words, shingle)
                node.append(_word_hash(words))
                n.append(len(hashes))
                fp.append(simhash.fingerprint_of(text))
                keys.append(prefix_of(hashes, levels.value, similarity).view(np.int64))
                sketch = sketch_of(hashes) if len(hashes) else None
                wide.append(np.empty(0, np.int64) if sketch is None else wide_of(sketch).view(np.int64))
                bits.append(np.empty(0, np.int64) if sketch is None else bits_of(sketch).view(np.int64))
                odd.append(odd_sketch(hashes))
            yield pa.record_batch({"doc_id": part.column(0), "text_key": part.column(2), "node": pa.array(node, pa.int64()), "n": pa.array(n, pa.int64()), "fp": pa.array(fp, pa.int64()), "keys": pa.array(keys, longs), "wide": pa.array(wide, longs), "bits": pa.array(bits, longs), "odd": pa.array(odd, longs)})

    return _texts(docs, id_col, text_col).mapInArrow(batches, "doc_id long, text_key long, node long, n long, fp long, keys array<long>, wide array<long>, bits array<long>, odd array<long>")


def _can(similarity: float, n: str = "n", at: str = "at", m: str = "m", to: str = "to") -> Column:
    """Whether postings (n, at) and (m, to) of one list leave room for the similarity."""
    needed = (F.col(n) + F.col(m)) * F.lit(similarity / (1 + similarity))
    return (F.least(n, m) >= similarity * F.greatest(n, m) - 1e-6) & (F.least(F.col(n) - F.col(at), F.col(m) - F.col(to)) >= needed - 1e-6)


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY, told: dict | None = None) -> DataFrame:
    """One row (doc_id, text_key, root) per document; documents of one root are linked by pairs at or over the similarity. ``told`` is given what it took."""
    if not 0.5 < similarity <= 1:
        raise ValueError(f"lists grow long at similarities as low as {similarity}")
    with small_batches(docs.sparkSession):
        return _components(docs, id_col, text_col, shingle, similarity, told)


def _components(docs: DataFrame, id_col: str, text_col: str, shingle: int, similarity: float, told: dict | None) -> DataFrame:
    own = materialize(word_keys(docs, id_col, text_col), "near-words")
    few = ("n", "fp", "keys", "wide", "bits", "odd")
    distinct = profiles(docs, id_col, text_col, shingle, similarity).groupBy("node").agg(F.min(F.struct("doc_id", "text_key")).alias("rep"), *(F.first(c).alias(c) for c in few))
    distinct = materialize(distinct, "near-distinct")
    met = materialize(linking.several(distinct.select(F.posexplode("keys").alias("at", "key"), "node", "n")), "near-lists")
    lists = materialize(linking.one_of_each(met), "near-lists")
    drop(met)
    # Texts without a word have no list; the fingerprints and wide buckets are of texts that a list has.
    info = distinct.join(materialize(lists.select("node").distinct(), "near-met"), "node", "left_semi")
    more = ("n", "at", "fp", "bits", "odd")
    prints = simhash.index(info.groupBy("fp").agg(F.min("node").alias("first"))).select(F.xxhash64("combo", "key").alias("key"), "fp")
    prints = prints.join(info.select("fp", "node", "n", "bits", "odd", F.lit(0).alias("at")), "fp")
    first = materialize(linking.several(prints.select("key", "node", *more)), "near-prints")
    wide = materialize(linking.several(info.select(F.explode("wide").alias("key"), "node", "n", "bits", "odd", F.lit(0).alias("at"), F.lit(None).cast("long").alias("fp"))), "near-wide")
    tiers = [first, wide, lists.join(info.select("node", "bits", "odd", F.lit(None).cast("long").alias("fp")), "node")]

    def can(a: str, b: str) -> Column:
        near = F.col(f"{a}fp").isNull() | simhash.links(F.col(f"{a}fp"), F.col(f"{b}fp"))  # only the fingerprints' lists have them
        return _can(similarity, f"{a}n", f"{a}at", f"{b}n", f"{b}at") & near & bits_allow(f"{a}bits", f"{b}bits", similarity) & odd_allows(a, b, int(100 * similarity + 1e-9))

    alike = lambda common, n, m: common >= (similarity - 1e-12) * (n + m - common)

    def checked(pairs: DataFrame) -> DataFrame:
        """The pairs that are links. Sets are made for the texts of these pairs alone, since most texts that meet others are in none."""
        some = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
        wanted = materialize(info.join(some, "node", "left_semi").select("node", "rep.doc_id", "rep.text_key"), "near-wanted")  # of known size: while they are few, no text is shuffled
        sets = materialize(sets_of(docs, wanted, id_col, text_col, shingle).dropDuplicates(["node"]), "near-sets")
        found = materialize(linking.checked_on_sets(pairs, sets, alike), "near-found")
        drop(wanted, sets)
        return found

    roots = linking.linked(tiers, checked, more, can, told)
    return own.join(roots.withColumnRenamed("u", "node"), "node", "left").select("doc_id", "text_key", F.coalesce("v", "node").alias("root"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """One row of ``docs`` for each component, all columns as they are: the one with the smallest doc_id, then the least hash of its text, then the least digest."""
    if clash := [c for c in docs.columns if c.lower().startswith("_sim_")]:
        raise ValueError(f"docs has columns of names used here: {clash}")
    times = components(docs, id_col, text_col, **more).groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("n"))
    best = times.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("lone"), "doc_id", "text_key", "n")).alias("k"))
    kept = materialize(best.select(F.col("k.doc_id").alias("_sim_id"), F.col("k.text_key").alias("_sim_kept"), F.col("k.n").alias("_sim_n")), "near-kept")
    keyed = docs.withColumn("_sim_key", text_key(text_col))
    meets = F.col(id_col).cast("long").eqNullSafe(F.col("_sim_id")) & (F.col("_sim_key") == F.col("_sim_kept"))
    out = keyed.join(kept.where("_sim_n = 1"), meets, "left_semi").select(*docs.columns)
    again = kept.where("_sim_n > 1")
    if not again.isEmpty():
        whole = F.struct(*docs.columns)
        of = keyed.join(again, meets, "left_semi").groupBy(F.col(id_col).cast("long"), "_sim_key").agg(F.min_by(whole, F.sha2(F.to_json(whole), 256)).alias("_sim_row"))
        out = out.union(of.select("_sim_row.*"))
    return out

"""Sets of shingles, as the near-copy operators share them: the sorted 64-bit hashes of a text's distinct shingles of words in ASCII lower case."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER

SEED = 42
CELLS = 1024
_CHUNK, _ROWS = 1 << 14, 512


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(ASCII_LOWER).split()


def shingles_of(words: list[bytes], shingle: int = 5) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    if not words:
        return np.empty(0, np.uint64)
    joined, n, digest = b" ".join(words), max(1, len(words) - shingle + 1), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts, stops, out = np.concatenate([[0], ends[: n - 1] + 1]), ends[min(shingle, len(words)) - 1 :], np.empty(n, np.uint64)
    for k in range(0, n, _CHUNK):  # so that a long text makes few objects at a time
        part = zip(starts[k : k + _CHUNK].tolist(), stops[k : k + _CHUNK].tolist())
        out[k : k + _CHUNK] = np.fromiter((digest(joined[a:b], SEED) for a, b in part), np.uint64, min(_CHUNK, n - k))
    return np.unique(out)


def text_key(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def odd_sketch(hashes: np.ndarray) -> np.ndarray:
    """Whether an odd number of the hashes falls into each of ``CELLS`` cells, one bit a cell: two sets differ in at least as many elements as their sketches in bits."""
    cells = np.bincount(((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % CELLS, minlength=CELLS)
    return np.packbits(cells & 1 == 1).view(np.int64)


def slices(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, since texts may be long."""
    for whole in parts:
        for k in range(0, whole.num_rows, _ROWS):
            yield whole.slice(k, _ROWS)


def odd_allows(a: str, b: str, percent: int) -> Column:
    """Whether two odd sketches leave room for the similarity: sets as alike differ in at most (100 - percent) / (100 + percent) of their sizes. Refuses no link.

    ``a`` and ``b`` are the prefixes of columns ``n`` and ``odd``.
    """
    differ = sum((F.bit_count(F.col(f"{a}odd")[i].bitwiseXOR(F.col(f"{b}odd")[i])) for i in range(CELLS // 64)), F.lit(0))
    return (100 + percent) * differ <= (100 - percent) * (F.col(f"{a}n") + F.col(f"{b}n"))


def sets_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(node, hashes) of the wanted (node, doc_id, text_key): the hashes as bytes. Rows may be repeated, and an id may be null.

    Repeated rows come one after the other from the join, and one of them is given; where adaptive execution splits them over tasks, a node may be given again.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for part in slices(parts):
            nodes, sets = [], []
            for node, text in zip(part.column(0).to_pylist(), part.column(1)):
                if node != last:
                    nodes.append(node)
                    sets.append(shingles_of(words_of(text.as_py()), shingle).tobytes())
                last = node
            yield pa.record_batch({"node": pa.array(nodes, pa.int64()), "hashes": pa.array(sets, pa.binary())})

    texts = docs.select(F.col(id_col).cast("long").alias("_id"), text_key(text_col).alias("_key"), F.col(text_col).cast("string").cast("binary").alias("text"))
    met = texts.join(wanted, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_key") == F.col("text_key"))).select("node", "text")
    return met.mapInArrow(batches, "node long, hashes binary")

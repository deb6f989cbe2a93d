"""Mixing by iterative proportional fitting: rake token weights to marginals, then sample by the calibrated probabilities.

Documents fall into cells of source, language and topic. Only the cells' token sums are gathered: categories are those
that the targets name, and ``other``, so there are at most as many cells as the targets allow, whatever the corpus.

The driver rakes inclusion probabilities. A cell's probability is the least of 1 and ``share`` times one multiplier for each of its three categories;
each step sets one category's multiplier so that its expected tokens meet its target, given the others', until all marginals fit at once.
A target's share is of the budget, which is ``share`` of all tokens. Where a category has too few tokens for its target it is
taken whole and the rest of its target goes to the others of its dimension in proportion, so that all dimensions ask for the same sum. A weight of 0 takes nothing, and what it
forbids counts for no other category. A category that no target names, ``other`` among them, keeps its observed share. What was asked, what could be asked and what is expected
are in ``Mix.expected``; ``Mix.fits`` tells whether all marginals came within ``FIT`` of what could be asked (marginals can contradict each other; then the last ones raked, topics, fit best), and
``mixed`` logs a warning where they did not; ``Mix.short`` lists the categories that are off what was asked, which ``mixed`` logs too.

Topics are clusters of texts within a language: spherical k-means over hashed words, weighted by their rarity, and named topic1 and on by size. Rarity and centroids come from all texts, copies
included, in at most ``PASSES`` passes over their hashed words; the passes start from centroids of a bounded sample of distinct texts (``SAMPLE`` texts and ``SAMPLE_BYTES`` bytes, those of the least hashes). Every whole text goes to the
nearest centroid of its language. Any other topic expression can be given instead.

A document is taken if a number in [0, 1) made from a digest of seed, id and text is below its cell's probability: the same
documents at any partitioning, and nested samples for nested probabilities. Texts are read twice more than the sample's pass; nothing but cell sums and clusters' sums is shuffled.

Defined results: null source or language is ``other``; null text and text without words have no tokens, and topic ``other``, as have texts of a language without any in the sample. Null ids
take part; equal rows are taken or left together. An empty table gives no rows. Cells without tokens have probability 1, but 0 where a weight is 0. ``sample`` returns all columns of the input
as they are; column names starting with ``_mix_`` raise ValueError.
"""

from __future__ import annotations

import itertools
import logging
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ASCII_LOWER, drop, labelled_sample, local_rows, materialize, table

log = logging.getLogger(__name__)
OTHER, TOPIC_COUNT = "other", 4
SOURCES = {f"src{i}": 1.0 for i in range(20)}
LANGS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}
TOPICS = {f"topic{k}": 1.0 for k in range(1, TOPIC_COUNT + 1)}
TARGETS = (SOURCES, LANGS, TOPICS)
SHARE, SEED = 0.5, "mix-1"
TOLERANCE, MAX_ROUNDS, FIT, MOST = 1e-10, 2000, 1e-3, 1e12
SAMPLE, SAMPLE_BYTES, WORD_ROWS, STEPS = 2000, 4 << 20, 1 << 12, 12
PASSES, UNIT = 4, 1 << 20


def word_rows(text: bytes | None, rows: int = WORD_ROWS) -> np.ndarray:
    """The hashed words of a text."""
    words = (text or b"").translate(ASCII_LOWER).split()
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % np.uint32(rows)


@dataclass(frozen=True)
class TopicModel:
    """For each language a matrix of hashed words by clusters; a text's cluster has the greatest sum over its words."""

    weights: dict[str, np.ndarray]

    def predict(self, rows: np.ndarray, lang: str) -> str:
        found = self.weights.get(lang)
        return OTHER if found is None or not len(rows) else f"topic{1 + int(found[rows].sum(axis=0, dtype=np.float64).argmax())}"


def cluster(bags: list[np.ndarray], count: int, seed: int = 11, rows: int = WORD_ROWS) -> np.ndarray:
    """Spherical k-means of a few bags of hashed words: unit centers, that of the greatest cluster first."""
    counts = np.stack([np.bincount(b, minlength=rows) for b in bags]).astype(np.float32)
    rarity = np.log((1 + len(bags)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    points = np.sqrt(counts) * rarity
    points /= np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-12)
    rng, centers = np.random.default_rng(seed), points[:1]
    while len(centers) < min(count, len(points)):  # each new seed is drawn by its squared distance from the ones before
        far = np.maximum(1 - (points @ centers.T).max(axis=1), 0).astype(float) ** 2
        if not far.sum() > 1e-9:
            break
        centers = np.vstack([centers, points[rng.choice(len(points), p=far / far.sum())]])
    for _ in range(STEPS):
        own = (points @ centers.T).argmax(axis=1)
        sums = np.stack([points[own == k].sum(axis=0) if (own == k).any() else centers[k] for k in range(len(centers))])
        centers = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    sizes = np.bincount((points @ centers.T).argmax(axis=1), minlength=len(centers))
    return centers[np.argsort(-sizes, kind="stable")].astype(np.float32)


def bags_of(named: DataFrame) -> DataFrame:
    """(lang, bag) of (text, lang) for every text with words: its hashed words in order, two bytes each."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [np.sort(word_rows(t.as_py())).astype(np.uint16).tobytes() for t in part.column(0)]
            some = [i for i, f in enumerate(found) if f]
            yield pa.record_batch({"lang": part.column(1).take(pa.array(some, pa.int64())), "bag": pa.array([found[i] for i in some], pa.binary())})

    return named.select(F.col("text").cast("string").cast("binary").alias("text"), "lang").mapInArrow(batches, "lang string, bag binary")


def tallies(bags: DataFrame, rarity: Mapping[str, np.ndarray] | None = None, centers: Mapping[str, np.ndarray] | None = None, rows: int = WORD_ROWS) -> dict[tuple[str, int], tuple[int, np.ndarray]]:
    """Over all texts, for each language and nearest center: the number of texts and the sum of their unit vectors, in steps of 1 / ``UNIT``.

    Without ``centers``: in how many texts of a language each row occurs. Sums are of whole numbers, so the order of tasks changes nothing.
    """

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], np.ndarray] = {}
        for part in parts:
            langs = np.array(part.column(0).to_pylist(), object)
            held = [np.frombuffer(b.as_buffer(), np.uint16) for b in part.column(1)]
            for lang in sorted(set(langs) if centers is None else set(langs) & set(centers)):
                own = [held[i] for i in np.flatnonzero(langs == lang)]
                row, of = np.concatenate(own).astype(np.int64), np.repeat(np.arange(len(own)), [len(b) for b in own])
                begins = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (of[1:] != of[:-1])])
                times, row, of = np.diff(np.append(begins, len(row))), row[begins], of[begins]
                units, nearest, k = np.ones(len(row)), np.zeros(len(own), np.int64), 1
                if centers is not None:
                    firsts, k = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]), len(centers[lang])
                    value = np.sqrt(times) * rarity[lang][row]
                    value /= np.sqrt(np.add.reduceat(value**2, firsts))[of]
                    units = np.rint(value * UNIT)
                    nearest = np.stack([np.add.reduceat(value * c[row], firsts) for c in centers[lang]], axis=1).argmax(axis=1)
                sizes = np.bincount(nearest, minlength=k)
                added = np.bincount(nearest[of] * rows + row, weights=units, minlength=k * rows).astype(np.int64).reshape(k, rows)
                for j in np.flatnonzero(sizes).tolist():
                    sums[lang, j] = sums.get((lang, j), 0) + np.append(sizes[j], added[j])
        yield from told(sums)

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], np.ndarray] = {}
        for part in parts:
            for lang, j, data in zip(*(c.to_pylist() for c in part.columns)):
                sums[lang, j] = sums.get((lang, j), 0) + np.frombuffer(data, np.int64)
        yield from told(sums)

    def told(sums: dict[tuple[str, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
        for (lang, j), own in sums.items():
            yield pa.record_batch({"lang": pa.array([lang]), "center": pa.array([j], pa.int32()), "sums": pa.array([own.tobytes()], pa.binary())})

    schema = "lang string, center int, sums binary"
    got = bags.mapInArrow(count, schema).repartition("lang", "center").mapInArrow(add, schema).toArrow().to_pylist()  # a row for each center
    return {(r["lang"], r["center"]): (int(own[0]), own[1:]) for r in got for own in [np.frombuffer(r["sums"], np.int64)]}


def fit_topics(docs: DataFrame, langs: Mapping[str, float] = LANGS, count: int = TOPIC_COUNT, text_col: str = "text", lang_col: str = "lang") -> TopicModel:
    """Cluster the words of all texts, language by language; languages that no target names are one. A bounded sample gives the first centers, and nothing else."""
    seeds: dict[str, list[np.ndarray]] = {}
    named = docs.select(F.col(text_col).alias("text"), _named(F.col(lang_col).cast("string"), langs).alias("lang"))
    for text, lang in labelled_sample(named, F.lit(True), SAMPLE, SAMPLE_BYTES, salt="topic sample"):
        found = word_rows(text.encode("utf-8", "replace"))
        if len(found):
            seeds.setdefault(lang, []).append(found)
    if not seeds:
        return TopicModel({})
    centers = {lang: cluster(b, count) for lang, b in sorted(seeds.items())}
    bags = materialize(bags_of(named), "mix-bags")
    rarity = {lang: np.log((1 + n) / (1 + often)) + 1 for (lang, _), (n, often) in tallies(bags).items()}
    sizes: dict[str, list[int]] = {}
    for _ in range(PASSES):
        found = tallies(bags, rarity, centers)
        sizes = {lang: [found[lang, k][0] if (lang, k) in found else 0 for k in range(len(c))] for lang, c in centers.items()}
        moved = {lang: np.stack([found[lang, k][1] / np.linalg.norm(found[lang, k][1]) if (lang, k) in found else own for k, own in enumerate(c)]).astype(np.float32) for lang, c in centers.items()}
        still = all(np.array_equal(moved[lang], c) for lang, c in centers.items())
        centers = moved
        if still:
            break
    drop(bags)
    return TopicModel({lang: (rarity[lang][:, None] * c[np.argsort(-np.array(sizes[lang]), kind="stable")].T).astype(np.float32) for lang, c in centers.items()})


@dataclass(frozen=True)
class Mix:
    """Probability of each cell, and what the marginals came to."""

    cells: dict[tuple[str, str, str], float]
    expected: dict[tuple[int, str], tuple[float, float, float]]  # (dimension, category): tokens asked for, of them within reach, expected
    rounds: int

    def miss(self) -> float:
        """The greatest relative miss of what was within reach."""
        return max((abs(got - reach) / reach for _, reach, got in self.expected.values() if reach), default=0.0)

    @property
    def fits(self) -> bool:
        """Whether every marginal came within ``FIT`` of what was within reach."""
        return self.miss() <= FIT

    def short(self) -> dict[tuple[int, str], float]:
        """Categories whose expected tokens are off what was asked for by more than ``FIT``, and the ratio of the two: too few tokens in one, and the rest of its target in others."""
        return {k: got / asked for k, (asked, _, got) in self.expected.items() if asked and abs(got - asked) > FIT * asked}


def _multiplier(tokens: np.ndarray, q: np.ndarray, want: float) -> float:
    """The factor at which sum(tokens * min(1, q * factor)) is ``want``: piecewise linear, so solved by its knees; the last knee if all isn't enough."""
    some = q > 0
    t, q = tokens[some], q[some]
    if not len(q) or want <= 0:
        return 0.0
    order = np.argsort(-q)
    t, q = t[order], q[order]
    full, rest = np.concatenate([[0.0], np.cumsum(t)]), np.concatenate([np.cumsum((t * q)[::-1])[::-1], [0.0]])
    for k in range(len(q)):  # with the k greatest at 1
        factor = (want - full[k]) / rest[k]
        if factor * q[k] <= 1:
            return max(factor, 1 / q[k - 1] if k else 0.0)
    return 1 / q[-1]


def _shared_out(rest: float, weights: Mapping[str, float], room: Mapping[str, float]) -> dict[str, float]:
    """``rest`` in proportion to the weights, nobody over their room: what is over goes to the others."""
    out, left = {x: 0.0 for x in weights}, {x for x, w in weights.items() if w > 0 and room[x] > 0}
    while left and rest > 0:
        unit = rest / sum(weights[x] for x in left)
        full = {x for x in left if weights[x] * unit >= room[x]}
        for x in full or left:
            out[x] = room[x] if full else weights[x] * unit
            rest -= out[x]
        if not full:
            break
        left -= full
    return out


def rake(tokens: Mapping[tuple[str, str, str], float], targets: tuple[Mapping[str, float], ...], share: float) -> Mix:
    """Calibrate the cells' probabilities to targets (weights by category) for ``share`` of all tokens."""
    names = sorted(c for c, t in tokens.items() if t > 0)
    t = np.array([tokens[c] for c in names], float)
    allowed = np.array([all(w.get(x, 1.0) > 0 for w, x in zip(targets, c)) for c in names], bool)
    budget, dims = share * float(t.sum()), []
    for d, weights in enumerate(targets):
        members: dict[str, list[int]] = {}
        for i, c in enumerate(names):
            members.setdefault(c[d], []).append(i)
        rows = {x: np.array(i) for x, i in sorted(members.items())}
        room = {x: float(t[i][allowed[i]].sum()) for x, i in rows.items()}
        dims.append((weights, rows, room, {x: share * room[x] for x in rows if x not in weights}))
    total = min([budget, *(sum(free.values()) + sum(v for x, v in room.items() if x in weights) for weights, _, room, free in dims)]) if names else 0.0
    wants, expected = [], {}
    for d, (weights, rows, room, free) in enumerate(dims):
        named = {x: weights[x] for x in rows if x in weights}
        rest, sum_of = max(total - sum(free.values()), 0.0), sum(named.values())
        wants.append(free | _shared_out(rest, named, room))
        for x in rows:
            expected[d, x] = (share * float(t[rows[x]].sum()) if x in free else max(budget - sum(free.values()), 0.0) * named[x] / sum_of if sum_of else 0.0, wants[d][x], 0.0)
    each = [np.ones(len(names)) for _ in dims]
    p, rounds = np.where(allowed, share, 0.0), 0
    for rounds in range(1, MAX_ROUNDS + 1):
        before = p.copy()
        for d, (_, rows, _, _) in enumerate(dims):
            q = np.where(allowed, share, 0.0) * np.prod([e for k, e in enumerate(each) if k != d], axis=0)
            for x, i in rows.items():
                each[d][i] = min(_multiplier(t[i], q[i], wants[d][x]), MOST)  # contradictions would let them grow without end
            p = np.minimum(1.0, q * each[d])
        if not len(p) or np.abs(p - before).max() < TOLERANCE:
            break
    for d, (_, rows, _, _) in enumerate(dims):
        for x, i in rows.items():
            expected[d, x] = (*expected[d, x][:2], float((t[i] * p[i]).sum()))
    return Mix(dict(zip(names, p.tolist())), expected, rounds)


def _named(value: Column, names: Mapping[str, float]) -> Column:
    return F.when(value.isin(*names), value).otherwise(F.lit(OTHER)) if names else F.lit(OTHER)


def celled(docs: DataFrame, targets=TARGETS, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic: Column | None = None, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (all if not given) with each row's cell, ``_mix_tokens`` and its number ``_mix_u`` in [0, 1)."""
    if clash := [c for c in docs.columns if c.lower().startswith("_mix_")]:
        raise ValueError(f"docs has columns of names used here: {clash}")
    model = fit_topics(docs, targets[1], max(1, len(targets[2])), text_col, lang_col) if topic is None else None
    kept, text = docs.columns if columns is None else columns, F.col(text_col).cast("string")
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(text, F.lit(""))).cast("binary"))
    rows = docs.select(
        *kept, _named(F.col(source_col).cast("string"), targets[0]).alias("_mix_source"), _named(F.col(lang_col).cast("string"), targets[1]).alias("_mix_lang"),
        (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / float(1 << 52)).alias("_mix_u"), (F.lit(None) if topic is None else topic).cast("string").alias("_mix_topic"), text.cast("binary").alias("_mix_text"),
    )
    at = {c: i for i, c in enumerate(rows.columns)}
    schema = T.StructType([f for f in rows.schema.fields if f.name != "_mix_text"]).add("_mix_tokens", "long")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            topics, tokens = [], []
            for text, lang in zip(part.column(at["_mix_text"]), part.column(at["_mix_lang"]).to_pylist()):
                found = word_rows(text.as_py())
                tokens.append(len(found))
                topics.append(model.predict(found, lang) if model else None)
            columns = [part.column(at[f.name]) for f in schema.fields[:-1]]
            if model:
                columns[-1] = pa.array(topics, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(tokens, pa.int64())], schema.names)

    return rows.mapInArrow(batches, schema).withColumn("_mix_topic", _named(F.col("_mix_topic"), targets[2]))


KEYS = ["_mix_source", "_mix_lang", "_mix_topic"]


def mixed(docs: DataFrame, targets=TARGETS, share: float = SHARE, **more) -> tuple[DataFrame, Mix]:
    """Rows of ``celled``, written once, with ``_mix_p``, ``_mix_kept`` and each category's target and expected tokens; and the fitted mix."""
    rows = materialize(celled(docs, targets, **more), "mix-cells")
    sums = rows.groupBy(*KEYS).agg(F.sum("_mix_tokens").alias("t")).collect()
    mix = rake({(r[0], r[1], r[2]): r["t"] for r in sums}, targets, share)
    if not mix.fits:
        log.warning("the marginals contradict each other: after %d rounds one misses its target by %.1f %%", mix.rounds, 100 * mix.miss())
    if short := mix.short():
        told = ", ".join(f"{('source', 'language', 'topic')[d]} {x}: {ratio:.2f}" for (d, x), ratio in sorted(short.items()))
        log.warning("tokens don't suffice for what was asked; expected over asked: %s", told)
    forbidden = lambda c: any(w.get(x, 1.0) <= 0 for w, x in zip(targets, c))
    known = [(*c, mix.cells.get(c, 0.0 if forbidden(c) else 1.0), *itertools.chain(*(mix.expected[d, x][::2] if (d, x) in mix.expected else (0.0, 0.0) for d, x in enumerate(c)))) for c in ((r[0], r[1], r[2]) for r in sums)]
    names = [f"_mix_{d}_{k}" for d in ("source", "lang", "topic") for k in ("target", "expected")]
    cells = local_rows(docs.sparkSession, known, ", ".join(f"{k} string" for k in KEYS) + ", _mix_p double, " + ", ".join(f"{n} double" for n in names))
    joined = rows.join(F.broadcast(cells), KEYS)  # as many rows as there are cells, which the targets bound
    return joined.withColumn("_mix_kept", F.col("_mix_u") < F.col("_mix_p")), mix


def sample(docs: DataFrame, **more) -> DataFrame:
    """The taken documents, all columns as they are."""
    return mixed(docs, **more)[0].where("_mix_kept").select(*docs.columns)


def op10_ipf_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its cell, its probability, whether it is taken, and what its categories were asked for and are expected to give."""
    rows, _ = mixed(table(spark, sf_dir, "documents"), columns=["doc_id"])
    of = [F.col(f"_mix_{d}_{k}").alias(f"{d}_{k}") for d in ("source", "lang", "topic") for k in ("target", "expected")]
    return rows.select("doc_id", F.col("_mix_source").alias("source"), F.col("_mix_lang").alias("lang"), F.col("_mix_topic").alias("topic"), F.col("_mix_p").alias("probability"), F.col("_mix_kept").alias("kept"), F.col("_mix_tokens").alias("n_tokens"), *of)


QUERIES = {"op10_ipf_source_mixing": op10_ipf_source_mixing}
ORACLES: dict[str, str] = {}

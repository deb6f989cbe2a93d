"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text's features are the 2- to 4-grams of characters of its lower-cased words, a space standing
at either side of a word, hashed to a fixed number of embedding rows. The average of the rows goes
through a linear softmax. Embeddings and softmax are trained together by stochastic gradient descent
in numpy, on a bounded sample of labelled texts and their lines, so that short texts are seen too. A fifth of the sampled texts is kept for
calibration: they fit the softmax temperature, and the score under which a prediction is rejected, such that no more than
``MAX_FALSE_REJECTION`` of right predictions fall under it.

The sample is bounded by two parameters: no more than ``sample`` (``SAMPLE``) distinct pairs of text and language, and no more than ``most_bytes``
(``SAMPLE_BYTES``) bytes of text; a text over ``most_bytes / 64`` is not learnt from. Texts are chosen by a hash of the text alone, those of the
least hashes, so ids don't matter, copies of a text count once, and a hot text can't crowd out the others. Features are made minibatch by minibatch, so the driver never holds those of the whole sample.

Every whole text is scored, in blocks, against the broadcast model (a few MB, fixed by the
number of rows and languages); a text longer than a block is cut at white space and its parts are summed. No text is shuffled but those of the sample.

Defined results: null text, empty text and text without a letter (of Unicode's category L; ``²`` and ``Ⅷ`` are numbers) are ``und`` with score 0 and are rejected.
Without labelled rows everything is ``und``. Null lang rows aren't learnt from. Repeated rows are
predicted alike; ties between languages go to the first in order of name. Null and repeated ids change nothing. Extra columns are kept by ``keep_identified`` and otherwise ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, labelled_sample, table

UNKNOWN = "und"
SAMPLE, SAMPLE_BYTES = 3000, 4 << 20
ROWS, DIM, GRAMS, EPOCHS, BATCH, RATE = 1 << 16, 16, (2, 3, 4), 4, 64, 0.5
MAX_FALSE_REJECTION, MOST_REJECTED_SCORE = 0.001, 0.5
#: What may be a letter; ``str.isalpha`` tells letters (category L) from numbers like ² and Ⅷ.
_MAYBE = re.compile(r"[^\W\d_]")
_BLOCK = 1 << 18  # characters
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def has_letter(text: str | None) -> bool:
    return any(m[0].isalpha() for m in _MAYBE.finditer(text or ""))


def _codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text; ASCII and general punctuation become spaces."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = ((codes >= 97) & (codes <= 122)) | ((codes >= 0xC0) & ((codes < 0x2000) | (codes > 0x206F)))
    return np.where(letter, codes, np.uint32(32))


def features(texts: list[str], rows: int = ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of all n-grams of the texts, in order of the texts' index, which is the second array."""
    parts = [_codes(f" {t} ") for t in texts]
    owner = np.repeat(np.arange(len(parts), dtype=np.uint32), [len(p) for p in parts])
    codes = np.concatenate(parts) if parts else np.empty(0, np.uint32)
    letter, h, found, of = codes != 32, np.zeros(len(codes), np.uint32), [], []
    inner = np.ones(len(codes), bool)  # no space but at either end
    for n in range(1, GRAMS[-1] + 1):
        m = len(codes) - n + 1
        if m < 1:
            break
        h = (h[:m] ^ codes[n - 1 :]) * _FACTORS[n - 1]
        h ^= h >> np.uint32(15)
        if n > 2:
            inner = inner[:m] & letter[n - 2 : n - 2 + m]
        if n in GRAMS:
            ok = np.flatnonzero(inner[:m] & (letter[:m] | letter[n - 1 :]))
            found.append(h[ok] % np.uint32(rows))
            of.append(owner[ok])
    if not found:
        return np.empty(0, np.uint32), np.empty(0, np.uint32)
    found, of = np.concatenate(found), np.concatenate(of)
    if len(texts) > 1:
        order = np.argsort(of.astype(np.uint16) if len(texts) < 1 << 16 else of, kind="stable")  # numbers of 16 bits are sorted by radix
        found, of = found[order], of[order]
    return found, of


def bags(texts: list[str], rows: int = ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows of each text, their share of the text's n-grams, and the index of each one's text."""
    found, owner = features(texts, rows)
    small = len(texts) * rows < 1 << 32
    pair, n = np.unique((owner if small else owner.astype(np.uint64)) * (np.uint32 if small else np.uint64)(rows) + found, return_counts=True)
    owner, found = (pair // rows).astype(np.int64), (pair % rows).astype(np.int64)
    total = np.bincount(owner, weights=n, minlength=len(texts))
    return found, (n / total[owner]).astype(np.float32), owner


def _sums(values: np.ndarray, rows: np.ndarray, owner: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum of ``values[rows]`` for each owner 0..count-1, and the number of rows it is over."""
    out, sizes = np.zeros((count, values.shape[1])), np.zeros(count)
    if len(rows):
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        out[owner[starts]] = np.add.reduceat(values[rows], starts, axis=0, dtype=np.float64)
        sizes[owner[starts]] = np.diff(np.append(starts, len(owner)))
    return out, sizes


def _pieces(text: str) -> Iterator[str]:
    """The text in parts of about a block, cut at spaces, so that no n-gram is lost."""
    start = 0
    while len(text) - start > _BLOCK:
        cut = text.find(" ", start + _BLOCK)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:] if start else text


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass(frozen=True)
class LanguageModel:
    langs: list[str]
    embeddings: np.ndarray  # rows by dimensions; folded with the softmax where there are fewer languages than dimensions
    weights: np.ndarray | None
    bias: np.ndarray
    temperature: float
    threshold: float

    def logits(self, texts: list[str]) -> np.ndarray:
        sums, sizes = np.zeros((len(texts), self.embeddings.shape[1])), np.zeros(len(texts))
        ready: list[tuple[int, str]] = []
        size = 0
        parts = [(i, p) for i, text in enumerate(texts) for p in _pieces(text)]
        for nth, (i, part) in enumerate(parts):
            ready.append((i, part))
            size += len(part)
            if size >= _BLOCK or nth == len(parts) - 1:
                own, n = _sums(self.embeddings, *features([p for _, p in ready], len(self.embeddings)), len(ready))
                at = np.array([k for k, _ in ready])
                np.add.at(sums, at, own)
                np.add.at(sizes, at, n)
                ready, size = [], 0
        mean = sums / np.maximum(sizes, 1)[:, None]
        return (mean if self.weights is None else mean @ self.weights) + self.bias

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Languages and scores of whole texts."""
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        ready = [i for i, text in enumerate(texts) if has_letter(text)] if self.langs else []
        if ready:
            p = _softmax(self.logits([texts[k] for k in ready]) / self.temperature)
            best = p.argmax(axis=1)
            for k, b, s in zip(ready, best, p[np.arange(len(best)), best]):
                langs[k], scores[k] = self.langs[b], s
        return langs, scores


def _folded(langs, embeddings, weights, bias, temperature=1.0, threshold=0.0) -> LanguageModel:
    if len(langs) <= embeddings.shape[1]:
        embeddings, weights = embeddings @ weights, None
    return LanguageModel(langs, embeddings.astype(np.float32), weights, bias, temperature, threshold)


def gradient_step(embeddings: np.ndarray, weights: np.ndarray, bias: np.ndarray, texts: list[str], y: np.ndarray, rate: float) -> None:
    """One step, in place, down the gradient of the summed cross-entropy of the texts; the bias goes by its mean."""
    found, share, owner = bags(texts, len(embeddings))
    mean = np.zeros((len(texts), embeddings.shape[1]))
    if len(found):
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        mean[owner[starts]] = np.add.reduceat(embeddings[found] * share[:, None], starts, axis=0)
    error = _softmax(mean @ weights + bias)
    error[np.arange(len(texts)), y] -= 1
    back = (error @ weights.T).astype(np.float32)
    by_row = np.argsort(found.astype(np.uint16) if len(embeddings) <= 1 << 16 else found, kind="stable")
    row = found[by_row]
    if len(row):
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        embeddings[row[starts]] -= rate * np.add.reduceat(back[owner[by_row]] * share[by_row, None], starts, axis=0)
    weights -= rate * (mean.T @ error)
    bias -= rate * error.sum(axis=0) / len(texts)


def _minibatches(texts: list[str], order: np.ndarray) -> Iterator[np.ndarray]:
    """Runs of at most ``BATCH`` texts, and of one block of characters where a text alone isn't longer."""
    start = size = 0
    for at, i in enumerate(order):
        if at > start and (at - start == BATCH or size + len(texts[i]) > _BLOCK):
            yield order[start:at]
            start, size = at, 0
        size += len(texts[i])
    if len(order):
        yield order[start:]


def train(texts: list[str], labels: list[str], seed: int = 7, rows: int = ROWS) -> LanguageModel:
    """Train by stochastic gradient descent, then calibrate on the fifth of texts that was left out."""
    usable = [i for i, t in enumerate(texts) if has_letter(t)]
    texts, labels = [texts[i] for i in usable], [labels[i] for i in usable]
    langs = sorted(set(labels))
    if not langs:
        return LanguageModel([], np.zeros((1, 1), np.float32), None, np.zeros(1), 1.0, 1.0)
    rng, code = np.random.default_rng(seed), {x: i for i, x in enumerate(langs)}
    held = [i for i in range(len(texts)) if i % 5 == 4]
    examples = [(texts[i], code[labels[i]]) for i in range(len(texts)) if i % 5 != 4]
    examples += [(line, y) for text, y in examples for line in text.split("\n") if line != text and has_letter(line)]
    shown, y = [t for t, _ in examples], np.array([k for _, k in examples])
    embeddings = rng.uniform(-1 / DIM, 1 / DIM, (rows, DIM)).astype(np.float32)
    weights, bias = np.zeros((DIM, len(langs))), np.zeros(len(langs))
    seen, all_of = 0, EPOCHS * len(shown)
    for _ in range(EPOCHS):
        for part in _minibatches(shown, rng.permutation(len(shown))):
            gradient_step(embeddings, weights, bias, [shown[i] for i in part], y[part], RATE * (1 - seen / all_of))
            seen += len(part)
    model = _folded(langs, embeddings, weights, bias)
    if not held:
        return model
    logits, truth = model.logits([texts[i] for i in held]), np.array([code[labels[i]] for i in held])
    temperature, threshold = calibrate(logits, truth)
    return LanguageModel(langs, model.embeddings, model.weights, model.bias, temperature, threshold)


def calibrate(logits: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """The temperature of the least cross-entropy, of a fixed grid, and the score under which a prediction is rejected."""
    loss = lambda t: -np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean()
    temperature = min(np.geomspace(0.05, 20, 61), key=loss)
    p = _softmax(logits / temperature)
    right = np.sort(p.max(axis=1)[p.argmax(axis=1) == truth])
    allowed = int(MAX_FALSE_REJECTION * len(right))
    return float(temperature), float(min(MOST_REJECTED_SCORE, right[allowed]) if len(right) else 0.0)


def fit(docs: DataFrame, usable: Column, sample: int = SAMPLE, most_bytes: int = SAMPLE_BYTES, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Train on the ``labelled_sample`` of the ``usable`` rows."""
    got = labelled_sample(docs, usable, sample, most_bytes, text_col, lang_col)
    return train([t for t, _ in got], [x for _, x in got])


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            langs, scores = model.predict(part.column(1).to_pylist())
            refused = [x == UNKNOWN or s < model.threshold for x, s in zip(langs, scores)]
            yield pa.record_batch({"doc_id": part.column(0), "lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores), "rejected": pa.array(refused, pa.bool_())})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(batches, "doc_id long, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose language the model doesn't reject."""
    at = docs.columns.index(text_col)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            langs, scores = model.predict(part.column(at).to_pylist())
            yield part.filter(pa.array([x != UNKNOWN and s >= model.threshold for x, s in zip(langs, scores)], pa.bool_()))

    return docs.mapInArrow(batches, docs.schema)


def learnable(id_col: str = "doc_id") -> Column:
    """Rows that may be learnt from: those outside the held-out quarter."""
    return fold(id_col, 4) != 2


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, fit(docs, learnable()))
    return found.select("doc_id", (~learnable()).alias("held_out"), "lang_pred", "score", "rejected")


QUERIES = {"op8_language_id": op8_language_id}
ORACLES: dict[str, str] = {}

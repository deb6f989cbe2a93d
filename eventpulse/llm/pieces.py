"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi.

The model file is read on the driver, parsed here (its wire format is plain protocol buffers) and broadcast; its size is that
of a vocabulary. A text is cut where no piece can reach across: before a run of the space mark, and at control characters
that no piece holds. In each unit the automaton reports, character by character and along its output links from the longest, the
pieces that end there, and each of them relaxes the best segmentation of the prefix up to there.

- Unigram models: a piece's score is added to that of the prefix before it, and the greatest sum wins.
- BPE models: the library's result is not the greatest sum of scores, it is what merging in order of rank leaves.
  There the prefix up to each place has one last piece: the piece ending there that stays apart when merged with the
  prefix's own last piece. So a piece relaxes a place if that pair, merged by itself, comes out unchanged; this is remembered by pair.

A character that is no piece falls back to its bytes, or to the unknown piece. Units seen before are remembered, up to a
bound, so each task's work follows its distinct words. Nothing is shuffled.

Defined results: null text has null ids and no pieces; empty text has empty ids. Repeated rows are encoded alike, texts of any length
whole. Ids out of range raise ValueError in decoding; bytes that are no UTF-8 decode to U+FFFD. Extra columns are ignored. Models with user-defined pieces
or a normalization table are refused with ValueError.
"""

from __future__ import annotations

import math
import re
import struct
from array import array
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Fixed values of the file format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
REMEMBERED, _LONG = 400_000, 64


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
            continue
        size = number() if tag & 7 == 2 else {1: 8, 5: 4}[tag & 7]
        yield tag >> 3, data[at : at + size]
        at += size


class PieceModel:
    """Pieces, scores and settings; encodes and decodes."""

    def __init__(self, pieces: list[tuple[str, float, int]], kind: int, dummy_prefix: bool = True, trim: bool = False) -> None:
        if any(k == USER_DEFINED for _, _, k in pieces):
            raise ValueError("user-defined pieces are not supported")
        self.pieces, self.kind, self.dummy_prefix, self.trim = pieces, kind, dummy_prefix, trim
        self.score = {p: s for p, s, k in pieces if k == NORMAL}
        self.id = {p: i for i, (p, _, k) in enumerate(pieces) if k == NORMAL}
        self.unknown = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), 0)
        self.byte = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == BYTE}
        self.unknown_score = min(self.score.values(), default=0.0) - 10
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id.items():
            self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        self.text_of = [b"" if k == CONTROL else bytes([int(p[3:5], 16)]) if k == BYTE else b" \xe2\x81\x87 " if k == UNKNOWN else p.replace(SPACE, " ").encode() for p, _, k in pieces]
        alphabet = set().union(*self.id) if self.id else set()
        lone = "".join(c for c in "\n\t\r\x0b\x0c" if c not in alphabet)
        inner = any(SPACE in p.lstrip(SPACE) for p in self.id)  # pieces that reach across words: units are whole texts
        self.units = re.compile("(?s).+" if inner else f"{SPACE}*[^{SPACE}{lone}]+|{SPACE}+" + (f"|[{lone}]" if lone else "")).findall
        self.apart: dict[int, bool] = {}
        self.states: dict[int, tuple[list[str], list[str], list[float]]] = {}
        self.seen: dict[str, bytes] = {}

    @classmethod
    def parse(cls, data: bytes) -> PieceModel:
        pieces, kind, prefix, trim = [], UNIGRAM, True, True
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, NORMAL)))
            elif number == 2:
                kind = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                settings = dict(_fields(value))
                prefix, trim = bool(settings.get(3, 1)), bool(settings.get(4, 1))
                if settings.get(2):
                    raise ValueError("models with a normalization table are not supported")
        if kind not in (UNIGRAM, BPE):
            raise ValueError(f"unknown kind of model {kind}")
        return cls(pieces, kind, prefix, trim)

    def merged(self, text: str) -> list[str]:
        """What merging the best-scored pair again and again, leftmost first, leaves of a short text."""
        return self.merges(text)[-1][2]

    def merges(self, text: str) -> list[tuple[str, str, list[str], float | None]]:
        """The states of a short text as it is merged: first part, last part, all parts, and the score of the merge that comes next (None: none)."""
        parts, score, states = list(text), self.score.get, []
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            states.append((parts[0], parts[-1], parts[:], best))
            if at < 0:
                return states
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def ends(self, piece: int) -> tuple[list[str], list[str], list[float]]:
        """First parts, last parts and scores of the merges to come (the last: below any) of a piece's states; no states if merging makes something else of it."""
        known = self.states.get(piece)
        if known is None:
            made = self.merges(self.pieces[piece][0])
            whole = len(made[-1][2]) == 1
            known = self.states[piece] = ([m[0] for m in made], [m[1] for m in made], [-math.inf if m[3] is None else m[3] for m in made]) if whole else ([], [], [])
        return known

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether merging the two pieces' texts as one text leaves the two.

        Until parts of both are merged, either side goes through the states that it has by itself, the better-scored merge first; so only the parts that touch are looked at in each.
        """
        known = self.apart.get(left * len(self.pieces) + right)
        if known is None:
            if len(self.apart) >= REMEMBERED:
                self.apart.clear()
            known = self.apart[left * len(self.pieces) + right] = self._stay_apart(self.ends(left), self.ends(right))
        return known

    def _stay_apart(self, a: tuple[list[str], list[str], list[float]], b: tuple[list[str], list[str], list[float]]) -> bool:
        (_, last, next_a), (first, _, next_b), score = a, b, self.score.get
        if not last or not first:
            return False
        i = j = 0
        while True:
            across, p, q = score(last[i] + first[j]), next_a[i], next_b[j]
            if across is not None and across > p and across >= q:  # of equal scores the leftmost goes first
                return False
            if p >= q:
                if p == -math.inf:
                    return True
                i += 1
            else:
                j += 1

    def segment(self, unit: str) -> list[int]:
        """Ids of one unit; -1 - code point stands for a character that is no piece."""
        last, size = self._merged_prefixes(unit) if self.kind == BPE else self._best_prefixes(unit)
        out, at = [], len(unit)
        while at:
            out.append(last[at] if last[at] >= 0 else -1 - ord(unit[at - 1]))
            at -= size[at]
        return out[::-1]

    def _merged_prefixes(self, unit: str) -> tuple[list[int], list[int]]:
        """The last piece of each prefix as merging leaves it, and its length; -1 and 1 where a character that is no piece ends it."""
        last, size, known, many, done = [-1] * (len(unit) + 1), [1] * (len(unit) + 1), self.apart.get, len(self.pieces), -1
        for end, (piece, length) in self.automaton.iter(unit):  # of the pieces that end at a place, the longest comes first
            if end == done:
                continue
            start = end + 1 - length
            if start and (before := last[start]) >= 0:
                apart = known(before * many + piece)
                if not (self.stay_apart(before, piece) if apart is None else apart):
                    continue
            last[end + 1], size[end + 1], done = piece, length, end
        return last, size

    def _best_prefixes(self, unit: str) -> tuple[list[int], list[int]]:
        """The last piece of each prefix's best sum of scores, and its length; -1 and 1 for a character that is no piece."""
        n = len(unit)
        last: list[int | None] = [None] * (n + 1)
        size, total = [1] * (n + 1), [0.0] * (n + 1)
        found = iter(self.automaton.iter(unit))
        here = next(found, None)
        for place in range(n):
            while here is not None and here[0] == place:
                piece, length = here[1]
                start, here = place + 1 - length, next(found, None)
                if last[place + 1] is None or total[start] + self.pieces[piece][1] > total[place + 1]:
                    last[place + 1], size[place + 1], total[place + 1] = piece, length, total[start] + self.pieces[piece][1]
            alone = total[place] + self.unknown_score
            if last[place + 1] is None or unit[place] not in self.id and alone > total[place + 1]:
                last[place + 1], size[place + 1], total[place + 1] = -1, 1, alone
        return last, size

    def ids_of(self, unit: str) -> bytes:
        """Ids of one unit as 32-bit numbers, characters that are no pieces resolved."""
        parts = self.segment(unit)
        if min(parts) >= 0:
            return array("i", parts).tobytes()
        out: list[int] = []
        for i in parts:
            if i >= 0:
                out.append(i)
            elif self.byte:
                out += [self.byte[b] for b in chr(-1 - i).encode("utf-8", "replace")]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return array("i", out).tobytes()

    def encode(self, text: str) -> np.ndarray:
        if self.trim:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return np.empty(0, np.int32)
        marked = ((" " if self.dummy_prefix else "") + text).replace(" ", SPACE)
        parts, seen = [], self.seen
        for unit in self.units(marked):
            ids = seen.get(unit)
            if ids is None:
                ids = self.ids_of(unit)
                if len(unit) <= _LONG:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen[unit] = ids
            parts.append(ids)
        return np.frombuffer(b"".join(parts), np.int32)

    def decode(self, ids: Iterable[int]) -> str:
        ids = ids.tolist() if isinstance(ids, np.ndarray) else list(ids)
        if ids and not 0 <= min(ids) <= max(ids) < len(self.pieces):
            raise ValueError("an id is out of range")
        text = b"".join(map(self.text_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


def read_model(path: str = MODEL) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_pieces, ids, round_trip) of every row; round_trip says whether the ids decode to the very text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = PieceModel.parse(shared.value)
        for part in parts:
            rows, same = [], []
            for text in part.column(1):
                text = text.as_py()
                rows.append(None if text is None else own.encode(text))
                same.append(None if text is None else own.decode(rows[-1]) == text)
            sizes = np.array([0 if r is None else len(r) for r in rows], np.int64)
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), mask=np.array([*(r is None for r in rows), False]))
            values = pa.array(np.concatenate([r for r in rows if r is not None] or [np.empty(0, np.int32)]))
            yield pa.record_batch({"doc_id": part.column(0), "n_pieces": pa.array(sizes), "ids": pa.ListArray.from_arrays(ends, values), "round_trip": pa.array(same, pa.bool_())})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(batches, "doc_id long, n_pieces long, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = PieceModel.parse(shared.value)
        for part in parts:
            texts = [None if not x.is_valid else own.decode(x.values.to_numpy(zero_copy_only=False)) for x in part.column(1)]
            yield pa.record_batch({"doc_id": part.column(0), "text": pa.array(texts, pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(batches, "doc_id long, text string")


def op6_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), read_model())


QUERIES = {"op6_sentencepiece_codec": op6_sentencepiece_codec}
ORACLES: dict[str, str] = {}

import hashlib
import random
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from eventpulse.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, n long"


def words(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return sum(1 for w in text.split(" ") if w)


def brute(rows, block=20, folds=4):
    """The contract's nodes from all prefixes. rows: (conv_id, turn, role, text)."""
    convs = {}
    for c, t, r, x in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        convs.setdefault(c, []).append((r or "", x or ""))
    whole = {}
    for c, own in convs.items():
        h = crc32(str(c).encode()) % folds
        whole[c] = tuple(convs.get(c - c % block, [])[:h] + own[h:])
    members = {}
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    out = []
    for p, own in members.items():
        under = [q for q in members if q[: len(p)] == p]
        kids = {q for q in under if len(q) == len(p) + 1}
        leaves = sum(1 for q in under if not any(len(z) == len(q) + 1 and z[: len(q)] == q for z in under))
        saved = sum((len(members[q]) - 1) * words(q[-1][1]) for q in under if q)
        ends = ",".join(str(c) for c in sorted(c for c in own if len(whole[c]) == len(p)))
        out.append((min(own), len(p), min(members[p[:-1]]) if p else None, len(own), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0]))


def nodes(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA)  # clashing names are ignored
    got = trie.prefix_trie(*trie.rebuilt(trie.ordered(frame)))
    return sorted((tuple(r) for r in got.collect()), key=lambda r: (r[1], r[0]))


def test_random_conversations_as_brute_force(spark):
    rng, rows = random.Random(5), []
    for c in rng.sample(range(400), 90):
        for t in range(rng.choice([1, 2, 3, 5, 9])):
            rows.append((c, t if rng.random() < 0.95 else None, rng.choice(["user", "assistant", None]), rng.choice(["a b", "a  b\tc", "", None, "Ünï x"])))
    assert nodes(spark, rows) == brute(rows)


def test_copies_ties_nulls_and_a_long_conversation(spark):
    long = [(c, t, "user", f"turn {t % 7} of it") for c in (40, 41, 60) for t in range(150)]
    rows = [*long, (None, 1, "user", "nobody's"), (3, 1, "b", "x"), (3, 1, "a", "y"), (3, 1, "a", "y"), (5, None, None, None), (7, 0, "user", "w " * 20_000)]
    rows += [(100 + k, 0, "user", "the same") for k in range(30)]
    assert nodes(spark, rows) == brute(rows)


def test_one_sequence_is_a_chain_from_the_root(spark):
    rows = [(c, t, "user", f"t{t} w") for c in (20, 21, 22) for t in range(4)]
    assert nodes(spark, rows) == brute(rows)


def test_turnless_conversations_end_at_the_root(spark):
    turnless = [c for c in range(1, 60) if crc32(str(c).encode()) % 4 == 3 and c % 20][:5]
    rows = [(c, 0, "user", "gone") for c in turnless]  # the first turns go, and there is none to take them from
    got = nodes(spark, rows)
    assert got == brute(rows) == [(min(turnless), 0, None, 5, 0, 1, 0, hashlib.sha256(",".join(map(str, turnless)).encode()).hexdigest())]


def test_no_conversations(spark):
    assert nodes(spark, []) == []


def test_lists_of_members_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "_PIECE", 3)
    members = spark.range(50).select((F.col("id") % 4).alias("rep"), (F.col("id") * 7).alias("conv_id"))
    got = dict(trie.members_digest(members).collect())
    assert got == {r: hashlib.sha256(",".join(str(7 * i) for i in range(50) if i % 4 == r).encode()).hexdigest() for r in range(4)}


@pytest.mark.parametrize("folds", [1, 3])
def test_other_rebuilding(spark, folds):
    rng = random.Random(folds)
    rows = [(c, t, "user", rng.choice("ab")) for c in range(25) for t in range(4)]
    frame = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA)
    got = trie.prefix_trie(*trie.rebuilt(trie.ordered(frame), 10, folds)).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: (r[1], r[0])) == brute(rows, 10, folds)

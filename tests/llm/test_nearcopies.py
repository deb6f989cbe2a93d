import math
import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from eventpulse.llm import linking as L
from eventpulse.llm import nearcopies as W
from eventpulse.llm import shingles as S
from eventpulse.llm.common import small_batches

SF = "/root/testdata/sf0.001"


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def components(texts):
    """Brute force over all pairs. texts: {doc_id: text}."""
    root, sets = {d: d for d in texts}, {d: shingles(t) for d, t in texts.items()}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in combinations(sorted(texts), 2):
        x, y = sets[a], sets[b]
        if (len(x & y) >= 0.8 * len(x | y)) if x or y else True:
            p, q = sorted((find(a), find(b)))
            root[q] = p
    return {find(d) for d in texts}


def test_stage_drops_near_copies_that_fingerprints_miss(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = components({r.doc_id: r.text for r in docs.collect()})
    got = C.near_dedup(spark, docs, SF)
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == sorted(want)


def test_a_chain_is_one_group_and_a_stray_is_not(spark):
    word = lambda i: f"w{i}"
    texts = [(i, " ".join(map(word, range(12 * i, 12 * i + 200)))) for i in range(8)] + [(20, " ".join(map(word, range(120))))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert len(shingles(texts[0][1]) & shingles(texts[2][1])) < 0.8 * len(shingles(texts[0][1]) | shingles(texts[2][1]))
    assert {r.doc_id for r in W.keep_one(docs).collect()} == components(dict(texts)) == {0, 20}


def test_defined_cases(spark):
    rows = [(5, "A b c"), (3, "a\tb C"), (None, "a b c"), (9, None), (8, ""), (None, "alone"), (None, "alone"), (2, "twice"), (2, "twice"), (7, "one text"), (7, "other text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in W.keep_one(docs).collect()), key=str)
    assert got == sorted([(3, "a\tb C"), (8, ""), (None, "alone"), (2, "twice"), (7, "one text"), (7, "other text")], key=str)
    assert W.keep_one(docs.where("false")).count() == 0
    with pytest.raises(ValueError, match="_sim_key"):
        W.keep_one(docs.withColumn("_sim_key", F.lit(1)))
    with pytest.raises(ValueError, match="0.5"):
        W.keep_one(docs, similarity=0.5)


def test_no_pair_is_lost_under_edits(spark):
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = []
    for g in range(12):
        base = [f"g{g}x{i}" for i in range(rng.randint(3, 120))]
        for _ in range(5):
            words = [w if rng.random() > 0.03 else f"e{rng.randint(0, 999)}" for w in base]
            texts.append(" ".join(words[: len(words) - rng.randint(0, len(words) // 6)]))
            texts.append(passage + " " + " ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in W.keep_one(docs).collect()} == components(dict(enumerate(texts)))


def test_a_passage_many_share_meets_in_no_list(spark):
    passage = " ".join(f"p{i}" for i in range(85))
    texts = [f"{passage} " + " ".join(f"d{k}w{i}" for i in range(15)) for k in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    own = W.profiles(docs).collect()
    levels = W.frequencies(docs)
    shared = set.intersection(*({int(h) for h in W.shingles_of(t.encode().split())} for t in texts[:5]))
    posted = [sum((k & ((1 << 64) - 1)) in shared for k in r["keys"]) for r in own]
    assert max(posted) <= 5 and levels.max() > 0
    rows = spark.createDataFrame([(100, 16, 100, 16), (100, 5, 100, 5), (100, 5, 60, 0)], "n long, at long, m long, to long")
    assert [r.ok for r in rows.select(W._can(0.8).alias("ok")).collect()] == [False, True, False]
    assert W.keep_one(docs).count() == 600


def test_repeated_rows_leave_one_whole_row(spark):
    rows = [(1, "same text here", "b"), (1, "same text here", "a"), (1, "same text here", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {tuple(W.keep_one(spark.createDataFrame(order, docs.schema)).collect()[0]) for order in (rows, rows[::-1], rows[1:] + rows[:1])}
    assert len(got) == 1 and W.keep_one(docs).columns == docs.columns


def test_odd_sketches_bound_the_difference():
    rng = random.Random(2)
    for n in (1, 50, 5000):
        x, y = ({rng.getrandbits(64) for _ in range(n)} for _ in range(2))
        a, b = (np.array(sorted(s | set(list(x)[: n // 2])), np.uint64) for s in (x, y))
        bits = sum(int(v).bit_count() for v in (S.odd_sketch(a) ^ S.odd_sketch(b)).view(np.uint64))
        differ = len(set(a.tolist()) ^ set(b.tolist()))
        assert bits <= differ and bits % 2 == differ % 2 and (n == 5000 or bits >= 0.8 * differ)


@pytest.mark.parametrize("n", [300, 600])
def test_a_group_some_edits_from_one_base_costs_about_its_size(spark, n):
    """Each text is two words away from a base, so nearly all pairs meet in lists and are near the threshold."""
    rng, base = random.Random(n), [f"w{i}" for i in range(120)]
    texts = []
    for k in range(n):
        words = list(base)
        for at in rng.sample(range(120), 2):
            words[at] = f"e{k}x{at}"
        texts.append(" ".join(words))
    docs, told = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), {}
    roots = {r.root for r in W.components(docs, told=told).collect()}
    assert len(roots) == len(components(dict(enumerate(texts))))
    assert told["checked"] < 4 * n * math.log2(n)


def test_the_fingerprints_lists_come_first(spark):
    """Texts within 3 bits are linked by operator 9's index, and the stage's other lists find what is left."""
    base = [f"w{i}" for i in range(400)]
    texts = [(k, " ".join(base[:k] + [f"e{k}"] + base[k + 1 :])) for k in range(12)]
    prints = [W.simhash.fingerprint_of(t.encode()) for _, t in texts]
    rows = spark.createDataFrame([(a, b) for a in prints for b in prints], "a long, b long")
    assert [r.ok for r in rows.select(W.simhash.links(F.col("a"), F.col("b")).alias("ok")).collect()] == [((a ^ b) % 2**64).bit_count() <= 3 for a in prints for b in prints]
    own = {r.doc_id: r.fp for r in W.profiles(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert own == dict(enumerate(prints))


def test_lists_of_the_same_members_are_one_and_sets_are_of_pairs_alone(spark, monkeypatch):
    rows = [(1, n, at) for n, at in ((7, 3), (8, 4))] + [(2, n, at) for n, at in ((7, 1), (8, 2))] + [(3, n, at) for n, at in ((7, 5), (8, 6), (9, 0))]
    lists = spark.createDataFrame(rows, "key long, node long, at int")
    assert {r.key for r in L.one_of_each(lists).collect()} == {2, 3}
    texts = [" ".join([f"s{k // 2}p{i}" for i in range(6)] + [f"d{k}w{i}" for i in range(9)]) for k in range(60)]  # every two share a passage and are far from alike
    base = [f"w{i}" for i in range(60)]
    texts += [" ".join(base), " ".join(base[:-1] + ["end"])]
    docs, told, wanted, made = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), {}, [], W.sets_of
    monkeypatch.setattr(W, "sets_of", lambda docs, some, *more: (wanted.append(some.count()), made(docs, some, *more))[1])
    roots = {r.root for r in W.components(docs, told=told).collect()}
    assert len(roots) == len(components(dict(enumerate(texts)))) == 61
    assert sum(wanted) <= 2 * told["checked"] < 60


def test_few_rows_of_texts_go_to_a_worker_at_once(spark, monkeypatch):
    key, seen, write = "spark.sql.execution.arrow.maxRecordsPerBatch", [], W.materialize
    monkeypatch.setattr(W, "materialize", lambda df, label: seen.append(int(spark.conf.get(key))) or write(df, label))
    before = spark.conf.get(key)
    docs = spark.createDataFrame([(i, "one two three four five six seven") for i in range(3)], "doc_id long, text string")
    W.components(docs)
    assert seen and max(seen) <= 1000 and spark.conf.get(key) == before
    with pytest.raises(RuntimeError), small_batches(spark, 7):
        assert spark.conf.get(key) == "7"
        raise RuntimeError
    assert spark.conf.get(key) == before

import random

import numpy as np
import pytest

from eventpulse.llm import linking
from eventpulse.llm import minhash as M

SCHEMA = "doc_id long, text string, a string, n_shingles string"


def shingles(text, k=2):
    out = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        out = out.replace(c, " ")
    w = [x for x in out.split(" ") if x]
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(texts, percent=80, k=2):
    """{id: (n, smallest reachable id)} over all pairs."""
    sets, root = {i: shingles(t, k) for i, t in texts.items()}, {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in texts:
        for j in texts:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in texts}


def found(spark, texts, **more):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in texts.items()], SCHEMA)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in M.components(docs, **more).collect()}


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


def test_clusters_of_edited_texts_as_brute_force(spark):
    rng, texts = random.Random(3), {}
    for c in range(12):
        base = [f"c{c}w{rng.randrange(200)}" for _ in range(rng.choice([6, 20, 90, 300]))]
        for _ in range(14):
            texts[len(texts) * 3 + 1] = edited(rng, base, rng.randrange(max(2, len(base) // 12)))
    for k in range(20):
        texts[1000 + k] = " ".join(f"z{rng.randrange(5)}" for _ in range(rng.randrange(1, 9)))  # small sets
    assert found(spark, texts) == brute(texts)


def test_a_group_that_hardly_links_costs_no_more_than_its_pairs_and_loses_none(spark):
    """Texts some edits away from one base: pairs meet in most buckets, and few are alike."""
    rng = random.Random(8)
    base = [f"w{k}" for k in range(60)]
    texts = {k: edited(rng, base, 4) for k in range(120)}
    told = {}
    assert found(spark, texts, told=told) == brute(texts)
    assert told["checked"] < 120 * 119 / 2 and told["rounds"] <= 12


def test_a_group_that_links_costs_about_its_size(spark):
    rng = random.Random(9)
    base = [f"w{k}" for k in range(200)]
    texts = {k: edited(rng, base, 2) for k in range(400)}
    told = {}
    assert found(spark, texts, told=told) == brute(texts)
    assert told["checked"] < 4 * 400 * np.log2(400)


def test_defined_cases(spark):
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
    rows = [(5, "Same words\tin here"), (3, "same words in HERE"), (5, "same words in here"), (9, None), (8, ""), (7, " \n"), (None, "same words in here"), (None, "alone"), (None, None), (6, "One"), (4, "one"), (2, long), (1, long + " tail"), (10, "É a"), (11, "é a")]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    got = sorted([(r.doc_id, r.n_shingles, r.component_id) for r in M.components(docs).collect()], key=str)
    n = len(shingles(long))
    assert got == sorted([(5, 3, 3), (3, 3, 3), (5, 3, 3), (9, 0, 9), (8, 0, 8), (7, 0, 7), (None, 3, 3), (None, 1, None), (None, 0, None), (6, 1, 4), (4, 1, 4), (2, n, 1), (1, n + 1, 1), (10, 1, 10), (11, 1, 11)], key=str)
    assert M.components(docs.where("false")).count() == 0


def test_sketches_agree_as_sets_do():
    """Over many pairs the share of agreeing bins is the similarity, for small sets too, which densification serves."""
    rng = np.random.default_rng(1)
    for size, common in [(9, 8), (40, 30), (3000, 2700)]:
        shares = []
        for _ in range(120):
            x = rng.integers(0, 2**63, 2 * size - common, dtype=np.uint64)
            a, b = M.sketch_of(x[:size]), M.sketch_of(x[size - common :])
            shares.append(np.mean(a == b))
            assert (a != 0).all()
        assert abs(np.mean(shares) - common / (2 * size - common)) < 0.03


def test_stars_lose_no_link_of_a_list(spark):
    """Ten members in one list of which only neighbours link: no centre is alike to all."""
    lists = spark.createDataFrame([(1, k) for k in range(10)] + [(2, 3), (2, 30)], "key long, node long")
    links = {(k, k + 1) for k in range(9)} - {(4, 5)}

    def check(pairs):
        return pairs.where(" or ".join(f"(least(u, v) = {a} and greatest(u, v) = {b})" for a, b in links))

    told = {}
    got = dict(linking.linked([lists], check, told=told).collect())
    assert got == {k: 0 for k in range(1, 5)} | {k: 5 for k in range(6, 10)}
    assert told["checked"] <= 46


def test_other_similarities_are_refused(spark):
    with pytest.raises(ValueError, match="80 to 100"):
        found(spark, {1: "a b"}, percent=50)


def test_pairs_that_cannot_link_are_refused_in_the_join(spark):
    """Of a group in which no two texts link, hardly a pair becomes a row to check, and all that link are found in few rounds."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    texts = {k: edited(rng, base, 9) for k in range(150)} | {200 + k: edited(rng, base, 1) for k in range(50)}
    told = {}
    assert found(spark, texts, told=told) == brute(texts)
    assert told["checked"] < 200 * 199 / 8 and told["rounds"] <= 4

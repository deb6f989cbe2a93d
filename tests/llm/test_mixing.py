import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventpulse.llm import mixing as M

SF = "/root/testdata/sf0.01"


def bisect(f, want, high=1.0):
    """The least x at which the growing f reaches ``want``, or where it stays flat."""
    while f(high) < want - 1e-9 and high < 1e12:
        high *= 2
    low = 0.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (low, mid) if f(mid) >= want - 1e-12 else (mid, high)
    return high


def plain_rake(tokens, targets, share, rounds=300):
    """Raking by bisection, cell by cell: p = min(1, share times three multipliers)."""
    cells = [c for c in tokens if tokens[c] > 0]
    fine = [c for c in cells if all(t.get(x, 1) > 0 for t, x in zip(targets, c))]
    room = [{x: sum(tokens[c] for c in fine if c[d] == x) for x in {c[d] for c in cells}} for d in range(3)]
    free = [{x: share * v for x, v in room[d].items() if x not in targets[d]} for d in range(3)]
    total = min([share * sum(tokens[c] for c in cells)] + [sum(free[d].values()) + sum(v for x, v in room[d].items() if x in targets[d]) for d in range(3)])
    wants = []
    for d in range(3):
        named = {x: targets[d][x] for x in room[d] if x in targets[d]}
        rest = total - sum(free[d].values())
        unit = bisect(lambda u: sum(min(room[d][x], w * u) for x, w in named.items()), rest)
        wants.append(free[d] | {x: min(room[d][x], w * unit) for x, w in named.items()})
    factor = [dict.fromkeys(room[d], 1.0) for d in range(3)]
    p = lambda c: min(1.0, share * factor[0][c[0]] * factor[1][c[1]] * factor[2][c[2]])
    for _ in range(rounds):
        for d in range(3):
            for x in room[d]:
                mine = [c for c in fine if c[d] == x]
                others = {c: share * np.prod([factor[k][c[k]] for k in range(3) if k != d]) for c in mine}
                factor[d][x] = bisect(lambda f: sum(tokens[c] * min(1.0, others[c] * f) for c in mine), wants[d][x]) if mine and wants[d][x] > 0 else 0.0
    return {c: p(c) if c in fine else 0.0 for c in cells}, wants


CASES = [
    (({"a": 1, "b": 2, "c": 1}, {"x": 0.5, "y": 0.5}, {"p": 0.7, "q": 0.3}), 0.1, 500, 1500, 0.0),  # nothing is capped
    (({"a": 1, "b": 2, "c": 1}, {"x": 0.5, "y": 0.5}, {"p": 0.7, "q": 0.3}), 0.6, 100, 2000, 0.0),  # some cells are taken whole
    (({"a": 2, "b": 1, "c": 0}, {"x": 0.6, "y": 0.4}, {"p": 1, "q": 1}), 0.3, 100, 2000, 0.0),  # a forbidden category
    (({"a": 1}, {"x": 1, "y": 1}, {"p": 0.9, "q": 0.1}), 0.5, 100, 2000, 0.25),  # categories without a target, cells without tokens
]


@pytest.mark.parametrize("targets,share,low,high,empty", CASES)
def test_rake_is_the_plain_one(targets, share, low, high, empty):
    for seed in range(4):
        rng = random.Random(seed)
        tokens = {c: 0 if rng.random() < empty else rng.randint(low, high) for c in itertools.product("abc", "xy", "pq")}
        tokens["a", "x", "p"] += low
        mix, (want, wants) = M.rake(tokens, targets, share), plain_rake(tokens, targets, share)
        assert all(0 <= p <= 1 for p in mix.cells.values()) and set(mix.cells) == set(want)
        for (d, x), (_, reach, got) in mix.expected.items():
            assert abs(reach - wants[d][x]) < 1e-3
            assert abs(got - sum(tokens[c] * p for c, p in mix.cells.items() if c[d] == x)) < 1e-6
        if mix.fits:
            assert max(abs(mix.cells[c] - want[c]) for c in want) < 2e-3
    assert mix.fits or empty


def test_zeros_stay_and_the_short_are_taken_whole():
    tokens = {("a", "x", "p"): 100, ("a", "y", "p"): 900, ("b", "x", "p"): 1000, ("b", "y", "p"): 1000}
    mix = M.rake(tokens, ({"a": 1, "b": 1}, {"x": 1, "y": 0}, {"p": 1}), 0.5)
    assert mix.cells["a", "y", "p"] == mix.cells["b", "y", "p"] == 0 and mix.cells["a", "x", "p"] == 1 and mix.cells["b", "x", "p"] == 1
    asked, reach, got = mix.expected[0, "a"]
    assert (asked, reach) == (750, 100) and abs(got - 100) < 1e-6 and mix.fits
    assert abs(next(r for r in mix.short().values() if r < 1) - 100 / 750) < 1e-6 and max(mix.short().values()) > 1  # told, though it fits what is there
    assert M._multiplier(np.array([100.0, 900.0]), np.array([0.5, 0.0]), 200) == 2
    short = M.rake({("a", "x", "p"): 10, ("b", "x", "p"): 1000}, ({"a": 1, "b": 1}, {"x": 1}, {"p": 1}), 0.5)
    assert short.cells["a", "x", "p"] == 1 and abs(short.cells["b", "x", "p"] - 0.495) < 1e-9 and short.expected[0, "a"][:2] == (252.5, 10)
    assert M.rake({}, ({}, {}, {}), 0.5).cells == {}


def test_marginals_that_contradict_each_other_are_told():
    mix = M.rake({("a", "x", "p"): 1000, ("b", "y", "p"): 1000}, ({"a": 1, "b": 1}, {"x": 3, "y": 1}, {"p": 1}), 0.4)
    assert not mix.fits and mix.miss() > 0.1 and mix.rounds <= M.MAX_ROUNDS


def plain_topic(model, text, lang):
    found = model.weights.get(lang)
    words = text.encode().lower().split()
    if found is None or not words:
        return "other"
    sums = [sum(float(found[zlib.crc32(w) % M.WORD_ROWS][k]) for w in words) for k in range(found.shape[1])]
    return f"topic{1 + sums.index(max(sums))}", sums


def test_clusters_find_planted_topics(spark):
    rng = random.Random(8)
    themes = [[f"{theme}{i}" for i in range(30)] for theme in ("sea", "law", "cell", "goal")]
    texts = [(i, " ".join(rng.choice(themes[i % 4] if rng.random() < 0.7 else ["the", "of", "and"]) for _ in range(60)), "en") for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    model = M.fit_topics(docs)
    got = [model.predict(M.word_rows(t.encode()), "en") for _, t, _ in texts]
    assert all(len({g for i, g in enumerate(got) if i % 4 == k}) == 1 for k in range(4)) and len(set(got)) == 4
    assert all(plain_topic(model, t, "en")[0] == g for (_, t, _), g in zip(texts, got))
    assert model.predict(M.word_rows(b"sea1"), "xx") == "other" and model.predict(M.word_rows(None), "en") == "other"


def test_clusters_are_of_all_texts_not_of_the_sample(spark, monkeypatch):
    """A sample gives the first centers alone: rarity and centroids know words that it lacks, at any partitioning."""
    monkeypatch.setattr(M, "SAMPLE", 4)
    texts = [(i, f"own{i} and shared words of{i % 2}", "en") for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    model, again = M.fit_topics(docs), M.fit_topics(docs.repartition(7))
    often = np.bincount(np.concatenate([np.unique(M.word_rows(t.encode())) for _, t, _ in texts]), minlength=M.WORD_ROWS)
    assert ((model.weights["en"].sum(axis=1) > 0) == (often > 0)).all() and np.array_equal(model.weights["en"], again.weights["en"])
    (n, counted), = M.tallies(M.bags_of(docs)).values()
    assert n == 60 and np.array_equal(counted, often)


@pytest.mark.parametrize("without_lang", [0, 3])
def test_query(spark, without_lang, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    if without_lang:
        docs = docs.withColumn("lang", F.when(F.col("doc_id") % without_lang != 0, F.col("lang")))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows, got = {r.doc_id: r for r in docs.collect()}, M.op10_ipf_source_mixing(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == set(rows) and len(got) == len(rows)
    model, tokens = M.fit_topics(docs), {}
    for r in got:
        d = rows[r.doc_id]
        u = int(hashlib.md5(f"mix-1|{d.doc_id}|{d.text}".encode()).hexdigest()[:13], 16) / 2**52
        assert r.kept == (u < r.probability) and (r.source, r.lang, r.n_tokens) == (d.source, d.lang or "other", len(d.text.encode().split()))
        topic, sums = plain_topic(model, d.text, r.lang)
        assert r.topic == topic or abs(max(sums) - sums[int(r.topic[5:]) - 1]) < 1e-3
        tokens[r.source, r.lang, r.topic] = tokens.get((r.source, r.lang, r.topic), 0) + r.n_tokens
    mix = M.rake(tokens, M.TARGETS, M.SHARE)
    assert mix.fits
    want, _ = plain_rake(tokens, M.TARGETS, M.SHARE, rounds=60)
    for r in got:
        cell = (r.source, r.lang, r.topic)
        assert abs(r.probability - mix.cells[cell]) < 1e-9 and abs(want[cell] - r.probability) < 0.02
        assert (r.source_target, r.source_expected, r.lang_target, r.lang_expected, r.topic_target, r.topic_expected) == pytest.approx(tuple(itertools.chain(*(mix.expected[d, x][::2] for d, x in enumerate(cell)))))
    share = sum(r.n_tokens for r in got if r.kept) / sum(tokens.values())
    assert abs(sum(mix.cells[c] * t for c, t in tokens.items()) / sum(tokens.values()) - 0.5) < 0.01 and abs(share - 0.5) < 0.08


def test_defined_cases(spark):
    rows = [(1, "a b c", "src1", "en", 1), (None, None, None, None, 1), (2, "", "nowhere", "xx", 1), (3, "| " * 50_000, "src2", "de", 1), (4, "A!! B!! C!!", "src1", "fr", 1), (5, "###%%%", "src1", "fr", 1)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, topic int")
    out, _ = M.mixed(docs)
    got = out.collect()
    assert len(got) == len(rows) and {r._mix_topic for r in got if not (r.text or "").strip()} == {"other"} and {r._mix_topic for r in got if r.doc_id == 3} == {"other"}
    assert all(r._mix_topic.startswith("topic") for r in got if r.doc_id in (1, 4, 5))  # the long text is the only one of its language, so that has no clusters
    assert {(r._mix_source, r._mix_lang) for r in got if r.doc_id in (None, 2)} == {("other", "other")} and {r._mix_tokens for r in got if r.doc_id in (None, 2)} == {0}
    for d in (1, 3, 4):
        assert len({r._mix_kept for r in got if r.doc_id == d}) == 1
    assert M.sample(docs).columns == docs.columns and M.sample(docs.where("false")).count() == 0
    with pytest.raises(ValueError, match="_mix_p"):
        M.mixed(docs.withColumn("_mix_p", F.lit(1)))
    own, _ = M.mixed(docs, topic=F.when(F.col("topic") == 1, "topic1"))
    assert {r._mix_topic for r in own.collect()} == {"topic1"}


def test_what_no_target_names_can_be_taken(spark):
    text = "some plain words of prose " * 20
    rows = [(i, text, s, x) for i, (s, x) in enumerate(itertools.product(["src1", "src2", "hot", None], ["en", "de", "it", None]))] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    out, mix = M.mixed(docs)
    p = {(r.source, r.lang): r._mix_p for r in out.collect()}
    assert len(p) == 16 and min(p.values()) > 0.05 and mix.fits
    tokens = sum(n for n in (len(r[1].split()) for r in rows))
    assert abs(mix.expected[0, "other"][2] - 0.5 * M.SHARE * tokens) < 1e-3 and abs(mix.expected[1, "other"][2] - 0.5 * M.SHARE * tokens) < 1e-3

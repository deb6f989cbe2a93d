import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from eventpulse.llm import langid as L
from eventpulse.llm.common import labelled_sample

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in L.op8_language_id(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert set(got) == {d.doc_id for d in docs}
    assert all(got[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2) for d in docs)
    held = [d for d in docs if got[d.doc_id].held_out]
    assert sum(got[d.doc_id].lang_pred == d.lang for d in held) / len(held) >= 0.97
    short = [d for d in held if len(d.text.split()) < 20]
    assert short and sum(got[d.doc_id].lang_pred == d.lang for d in short) / len(short) >= 0.8
    assert sum(got[d.doc_id].rejected for d in docs) <= 0.01 * len(docs)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_defined_cases(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et la souris", "fr"), (2, "le chat et la souris", "fr"), (3, None, "en"), (None, "the", None), (4, "", "fr"), (5, "12 345 !?", "en"), (6, "the dog " * 60_000, "en")]
    docs = spark.createDataFrame([(*r, "x") for r in rows * 2], "doc_id long, text string, lang string, score string")
    model = L.fit(docs, F.lit(True))
    got = L.identify(docs, model).collect()
    assert len(got) == len(rows) * 2
    for r in got:
        if r.doc_id in (3, 4, 5):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in ("en", "fr") and 0 < r.score <= 1
    kept = L.keep_identified(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()}.isdisjoint({3, 4, 5})
    none = L.fit(docs.where("false"), F.lit(True))
    assert {r.lang_pred for r in L.identify(docs, none).collect()} == {"und"} and L.identify(docs.where("false"), none).count() == 0


def test_lang_and_source_are_not_inputs():
    model = L.train(["the cat is here"] * 5 + ["le chat est la"] * 5, ["en"] * 5 + ["fr"] * 5)
    assert model.predict(["the cat is here", "le chat est la", None, "7"])[0] == ["en", "fr", "und", "und"]


def test_blocks_do_not_change_scores():
    model = L.train(["the cat is here\nand there"] * 5 + ["le chat est la\net la"] * 5, ["en"] * 5 + ["fr"] * 5)
    texts = ["the " * 400_000, "le chat", "", "Ça et là " * 10, "x"]
    together, alone = model.predict(texts)[1], [model.predict([t])[1][0] for t in texts]
    assert abs(together - alone).max() < 1e-6


def plain_rows(text, rows):
    """The rows of all n-grams, one by one: no space but at an n-gram's ends, and not at both."""
    padded = "".join(c if "a" <= c <= "z" or (ord(c) >= 0xC0 and not 0x2000 <= ord(c) <= 0x206F) else " " for c in f" {text.lower()} ")
    out = []
    for n in L.GRAMS:
        for i in range(len(padded) - n + 1):
            gram = padded[i : i + n]
            if " " in gram[1:-1] or (gram[0] == gram[-1] == " "):
                continue
            h = 0
            for k, c in enumerate(gram):
                h = ((h ^ ord(c)) * int(L._FACTORS[k])) % 2**32
                h ^= h >> 15
            out.append(h % rows)
    return out


def plain_loss(texts, y, embeddings, weights, bias):
    total, scores = 0.0, []
    for text, truth in zip(texts, y):
        rows = plain_rows(text, len(embeddings))
        mean = [sum(embeddings[r][d] for r in rows) / len(rows) if rows else 0.0 for d in range(len(embeddings[0]))]
        z = [b + sum(m * w[k] for m, w in zip(mean, weights)) for k, b in enumerate(bias)]
        e = [math.exp(v) for v in z]
        total -= math.log(e[truth] / sum(e))
        scores.append([v / sum(e) for v in e])
    return total, scores


TEXTS = ["The cat, and 12 dogs!", "le chat est là", "x", "7 8", "Straße über \u2014 ça"]


def test_softmax_is_the_plain_one():
    rng = random.Random(5)
    embeddings = np.array([[rng.gauss(0, 1) for _ in range(4)] for _ in range(64)], np.float32)
    weights, bias = np.array([[rng.gauss(0, 1) for _ in range(3)] for _ in range(4)]), np.array([0.1, -0.2, 0.3])
    for text in TEXTS:
        assert sorted(L.features([text], 64)[0].tolist()) == sorted(plain_rows(text, 64))
    _, want = plain_loss(TEXTS, [0] * 5, embeddings.tolist(), weights.tolist(), bias.tolist())
    for temperature in (1.0, 0.7):
        model = L.LanguageModel(["a", "b", "c"], embeddings, weights, bias, temperature, 0.0)
        langs, scores = model.predict(TEXTS)
        for text, lang, score, p in zip(TEXTS, langs, scores, want):
            q = [v ** (1 / temperature) for v in p]
            assert (lang, score) == ("und", 0.0) if text == "7 8" else (lang == "abc"[int(np.argmax(p))] and abs(score - max(q) / sum(q)) < 1e-5)


def test_step_goes_down_the_gradient():
    rng = random.Random(6)
    embeddings = np.array([[rng.gauss(0, 1) for _ in range(3)] for _ in range(32)], np.float32)
    weights, bias, y = np.array([[rng.gauss(0, 1) for _ in range(2)] for _ in range(3)]), np.array([0.3, -0.1]), np.array([0, 1, 1, 0, 1])
    e, w, b = embeddings.copy(), weights.copy(), bias.copy()
    L.gradient_step(e, w, b, TEXTS, y, 1e-3)

    def slope(which, at):
        parts = [embeddings.astype(float), weights.copy(), bias.copy()]
        both = []
        for h in (1e-5, -1e-5):
            parts[which][at] += h
            both.append(plain_loss(TEXTS, y, *(p.tolist() for p in parts))[0])
            parts[which][at] -= h
        return (both[0] - both[1]) / 2e-5

    for at in [(r, d) for r in range(32) for d in range(3)]:
        assert abs((embeddings[at] - e[at]) / 1e-3 - slope(0, at)) < 2e-3
    for at in [(d, k) for d in range(3) for k in range(2)]:
        assert abs((weights[at] - w[at]) / 1e-3 - slope(1, at)) < 1e-4
    for k in range(2):
        assert abs((bias[k] - b[k]) / 1e-3 - slope(2, k) / len(TEXTS)) < 1e-4


def test_calibration_is_the_plain_one():
    rng = np.random.default_rng(1)
    truth = rng.integers(0, 3, 400)
    logits = rng.normal(size=(400, 3)) + 6 * (np.arange(3) == truth[:, None])
    temperature, threshold = L.calibrate(logits, truth)
    nll = [sum(-math.log(math.exp(z[t] / s) / sum(math.exp(v / s) for v in z) + 1e-12) for z, t in zip(logits.tolist(), truth)) for s in np.geomspace(0.05, 20, 61)]
    assert temperature == np.geomspace(0.05, 20, 61)[int(np.argmin(nll))]
    p = [[math.exp(v / temperature) for v in z] for z in logits.tolist()]
    right = sorted(max(q) / sum(q) for q, t in zip(p, truth) if q.index(max(q)) == t)
    assert abs(threshold - min(0.5, right[int(0.001 * len(right))])) < 1e-9


def test_sample_is_bounded_and_blind_to_ids(spark):
    words = ["alpha", "beta", "gamma", "delta", "chat", "chien"]
    rng = random.Random(2)
    texts = [(" ".join(rng.choice(words) for _ in range(20)) + f" {chr(97 + i % 26)}{i}", ["en", "fr"][i % 2]) for i in range(2000)]
    schema = "doc_id long, text string, lang string"
    one_id = spark.createDataFrame([(1, *t) for t in texts], schema)
    null_id = spark.createDataFrame([(None if i % 2 else i, *t) for i, t in enumerate(texts)], schema)
    hot = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)] + [(7, "the hot text", "en")] * 4000, schema)
    samples = [labelled_sample(d, F.lit(True), 300, 1 << 20) for d in (one_id, null_id, hot)]
    assert [len(x) for x in samples] == [300] * 3 and samples[0] == samples[1] and all(len(set(x)) == 300 for x in samples)
    assert len(set(samples[2]) - set(samples[0])) <= 1
    assert len(labelled_sample(one_id, F.lit(True), 5000, 1 << 20)) == 2000
    small = labelled_sample(one_id, F.lit(True), 5000, 64 * 200)
    assert 0 < sum(len(t.encode()) for t, _ in small) <= 64 * 200
    assert labelled_sample(one_id.where("false"), F.lit(True), 10, 1 << 20) == []


def test_long_texts_are_summed_by_parts(monkeypatch):
    model = L.train(["the cat is here"] * 5 + ["le chat est la"] * 5, ["en"] * 5 + ["fr"] * 5)
    text = "the cat est ici et la souris " * 50
    whole = model.predict([text])[1][0]
    monkeypatch.setattr(L, "_BLOCK", 64)
    assert abs(model.predict([text])[1][0] - whole) < 1e-6 and abs(model.predict(["x", text, "y"])[1][1] - whole) < 1e-6


def test_numbers_are_no_letters(spark):
    """Letters are of category L: superscripts, fractions, Roman and circled numbers aren't, and ª and ʰ are."""
    texts = ["² ½", "Ⅷ", "①", "_ 12 ³", "²a", "ª", "ʰ"]
    assert [L.has_letter(t) for t in [None, "", *texts]] == [False, False, False, False, False, False, True, True, True]
    model = L.train(["the cat sat", "die katze sitzt", "² ½"] * 10, ["en", "de", "fr"] * 10)
    assert model.langs == ["de", "en"] and model.predict(texts)[0][:4] == ["und"] * 4 and "und" not in model.predict(texts)[0][4:]

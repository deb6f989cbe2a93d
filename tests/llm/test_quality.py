from fractions import Fraction
from math import comb

from pyspark.sql import functions as F

from eventpulse.llm import quality as Q


def repeated(text):
    words = text.split()
    seen = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    return len({p for v in seen.values() if len(v) > 1 for i in v for p in range(i, i + 8)})


def test_binomial_is_exact(spark):
    cases = [(0, 10), (3, 100), (0, 500), (7, 400), (40, 2000), (180, 5000), (1200, 25_000), (1, 20), (5, 5), (0, 0)]
    got = {(r.k, r.n): r.p for r in spark.createDataFrame(cases, "k long, n long").select("k", "n", Q.binomial_cdf(F.col("k"), F.col("n"), 0.05).alias("p")).collect()}
    for k, n in cases:
        want = 1.0 if k >= n * 0.05 else float(sum(comb(n, i) * Fraction(1, 20) ** i * Fraction(19, 20) ** (n - i) for i in range(k + 1)))
        assert abs(got[k, n] - want) <= 1e-9 * want, (k, n)


def test_defined_cases(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    texts = [None, "", " \n", passage, passage + " x y z " + passage, "a " * 50, "line one\nline one\n\nline two\nline one", "é" * 9 + "\tÀ #|", " ".join(f"w{i % 5000}" for i in range(60_000)), "one two three four five six seven eight " * 2]
    docs = spark.createDataFrame([(i if i else None, t, None, "x") for i, t in enumerate(texts)] * 2, "doc_id long, text string, lang string, n_words string")
    got = Q.measure(docs).collect()
    assert len(got) == 2 * len(texts)
    for r in got:
        text = texts[r.doc_id or 0] or ""
        lines = [x for x in text.split("\n") if x.split()]
        want = (len(text.split()), len("".join(text.split())), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeated(text))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and r.stratum == "other"
    labels = spark.createDataFrame([(1, None), (None, 1), (3, 1), (3, 0)], "doc_id long, quality int")
    rows = Q.judge(Q.measure(docs), Q.choose_levels(Q.measure(docs), labels)).collect()
    assert len(rows) == 2 * len(texts) and all(r.kept == (not r.base_failed) for r in rows)
    none = Q.measure(docs.where("false"))
    assert Q.judge(none, Q.choose_levels(none, labels.where("false"))).count() == 0


def test_false_rejection_is_limited(spark):
    # bad texts have symbols; one good text in ``share`` has as many
    def level(good, share):
        rows = [(i, "en", "not so" if i % share else "#" * 3 + " ok") for i in range(good)] + [(10_000 + i, "en", "### bad") for i in range(300)]
        docs = spark.createDataFrame([(i, x, " ".join(["word"] * 3 + [t] + [f"w{k}" for k in range(20)]) if t == "not so" else " ".join([t] + [f"#{k}####" for k in range(25)] + [f"w{k}" for k in range(20)])) for i, x, t in rows], "doc_id long, lang string, text string")
        labels = spark.createDataFrame([(i, int(i < 10_000)) for i, _, _ in rows], "doc_id long, quality int")
        measured = Q.measure(docs)
        return [tuple(r) for r in Q.choose_levels(measured, labels).collect()], measured, labels

    allowed, measured, labels = level(1000, 100)
    assert [s for s, _ in allowed] == ["en"]
    rows = Q.judge(measured, Q.choose_levels(measured, labels)).collect()
    assert sum(not r.kept for r in rows if r.doc_id >= 10_000) == 300 and sum(not r.kept for r in rows if r.doc_id < 10_000) == 10
    assert level(1000, 20)[0] == []  # 5 % of good texts would go
    assert level(100, 1000)[0] == []  # too few labels to tell

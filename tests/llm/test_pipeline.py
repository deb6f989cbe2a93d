import hashlib
import re

import pytest
import sentencepiece

import corpus_pipeline as C
from eventpulse.llm import langid, mixing, pieces
from eventpulse.llm.common import materialize

from .test_nearcopies import components

SF = "/root/testdata/sf0.001"
LOOSE = re.compile(r"\S+@\S+\.com|\d{16}|\+1 \(\d{3}\) \d{3}-\d{4}|\d+\.\d+\.\d+\.\d+|\b[0-9a-f]{40}\b")


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append({r.doc_id: r for r in docs.collect()})
    for name, stage in C.STAGES:
        columns = docs.columns
        docs = materialize(stage(spark, docs, SF), name)
        assert name == "encode" or docs.columns == columns
        rows = docs.collect()
        out.append({r.doc_id: r for r in rows})
        assert len(out[-1]) == len(rows)
    return out


def test_language_id(spark, stages):
    before, after = stages[0], stages[1]
    model = langid.fit(spark.read.parquet(f"{SF}/documents.parquet"), langid.learnable())
    langs, scores = model.predict([before[d].text for d in sorted(before)])
    assert set(after) == {d for d, x, s in zip(sorted(before), langs, scores) if x != "und" and s >= model.threshold}
    assert len(after) >= 0.98 * len(before)


def test_one_of_each_group(stages):
    before, after = stages[1], stages[2]
    assert set(after) == components({d: r.text for d, r in before.items()})
    assert all(after[d] == before[d] for d in after)


def test_personal_data(stages):
    before, after = stages[2], stages[3]
    assert set(after) == set(before)
    real = {m for r in before.values() for m in LOOSE.findall(r.text)}
    for d, r in after.items():
        assert not real & set(LOOSE.findall(r.text)) and LOOSE.sub("", r.text) == LOOSE.sub("", before[d].text)
        assert r.n_chars == len(r.text) and (r.lang, r.source) == (before[d].lang, before[d].source)


def test_mix(spark, stages):
    before, after = stages[3], stages[4]
    model = mixing.fit_topics(spark.createDataFrame([(r.text, r.lang) for r in before.values()], "text string, lang string"))
    rows = {d: mixing.word_rows(r.text.encode()) for d, r in before.items()}
    named = lambda x, names: x if x in names else "other"
    cell = {d: (named(r.source, mixing.SOURCES), named(r.lang, mixing.LANGS), named(model.predict(rows[d], named(r.lang, mixing.LANGS)), mixing.TOPICS)) for d, r in before.items()}
    tokens = {}
    for d in before:
        tokens[cell[d]] = tokens.get(cell[d], 0) + len(rows[d])
    mix = mixing.rake(tokens, mixing.TARGETS, mixing.SHARE)
    taken = {d for d, r in before.items() if int(hashlib.md5(f"{mixing.SEED}|{d}|{r.text}".encode()).hexdigest()[:13], 16) / 2**52 < mix.cells.get(cell[d], 1.0)}
    assert set(after) == taken and all(after[d] == before[d] for d in after)


def test_encode(stages):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    assert set(stages[5]) == set(stages[4])
    assert all(r.ids == library.encode(stages[4][d].text) and r.round_trip for d, r in stages[5].items())


def test_run_is_the_stages(spark, stages):
    assert {r.doc_id: r.ids for r in C.run(spark, SF).collect()} == {d: r.ids for d, r in stages[5].items()}


def test_awkward_rows_and_no_rows(spark):
    rows = [(1, None, None, None, None), (None, "the and of the dog", "en", "src1", 9), (2, "", "en", "x", 0), (3, "a@b.example.com the and of", "en", None, 1), (3, "a@b.example.com the and of", "en", None, 1)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for start in (docs, docs.where("false")):
        now = start
        for name, stage in C.STAGES:
            now = materialize(stage(spark, now, SF), name)
        assert now.count() <= 10

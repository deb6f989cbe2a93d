import itertools
import random

import pytest
import sentencepiece

from eventpulse.llm import pieces as P

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return P.PieceModel.parse(P.read_model())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=P.MODEL)


ODD = ["", " ", "  a  b ", "\n", "tab\there\r\n", "é😀ß漢字", "a" * 3000, "▁x", "x▁▁y", "Hello  world\n\tx", "0123 4567", "日本語のテキスト", "\x00\x0b", " " * 40, "xyzzy " * 500, "don't", "ÀÉÎ̈o", "<s> </s> <unk> <0x0A>"]


@pytest.mark.parametrize("text", ODD)
def test_as_the_library(model, library, text):
    assert model.encode(text).tolist() == library.encode(text)
    assert model.decode(model.encode(text)) == library.decode(library.encode(text))
    assert "▁" in text or model.decode(model.encode(text)) == text


def test_random_texts_as_the_library(model, library):
    rng = random.Random(2)
    for _ in range(400):
        text = "".join(rng.choice("abcdeéñßthe  in\nan., ▁The#|0 19") for _ in range(rng.randint(1, 60)))
        assert model.encode(text).tolist() == library.encode(text), text


def test_documents_as_the_library(spark, model, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in P.op6_sentencepiece_codec(spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        assert got[d.doc_id].ids == library.encode(d.text) and got[d.doc_id].n_pieces == len(got[d.doc_id].ids) and got[d.doc_id].round_trip


def test_pieces_stay_apart_as_merging_says(model):
    """Real pairs, and pairs of small models full of equal scores."""
    rng = random.Random(5)
    pairs = {(a, b) for text in ("the inanthe onening. reatherent", "ing that ofontion ▁and") for _, (a, _) in model.automaton.iter(text) for _, (b, _) in model.automaton.iter(text)}
    tried = [(model, a, b) for a, b in pairs]
    for _ in range(300):
        own = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(2, 12))}
        small = P.PieceModel([(w, -float(rng.randint(1, 4)), P.NORMAL) for w in sorted(own)], P.BPE, dummy_prefix=False)
        tried += [(small, a, b) for a in range(len(own)) for b in range(len(own))]
    seen = set()
    for m, a, b in tried:
        left, right = m.pieces[a][0], m.pieces[b][0]
        seen.add(m.stay_apart(a, b))
        assert m.stay_apart(a, b) == (m.merged(left + right) == [left, right]), (left, right, m.pieces)
    assert seen == {True, False}


def test_a_piece_is_merged_once_whatever_it_stands_beside(model, monkeypatch):
    fresh, calls, merges = P.PieceModel(model.pieces, model.kind), [], P.PieceModel.merges
    monkeypatch.setattr(P.PieceModel, "merges", lambda self, text: calls.append(text) or merges(self, text))
    monkeypatch.setattr(P.PieceModel, "merged", lambda self, text: calls.append(text) or merges(self, text)[-1][2])
    rng = random.Random(6)
    for _ in range(300):
        fresh.encode("".join(rng.choice(["the", "in", "an", "on", "re", "er", "ing"]) for _ in range(4)))
    assert len(fresh.apart) > 2 * len(calls) and len(calls) == len(set(calls))


def test_unigram_is_the_best_sum():
    rng = random.Random(4)
    letters = "abc"
    pieces = [("<unk>", 0.0, P.UNKNOWN)] + [(w, -rng.random() * 5 - 1, P.NORMAL) for n in (1, 2, 3) for w in map("".join, itertools.product(letters, repeat=n)) if n == 1 or rng.random() < 0.4]
    model = P.PieceModel(pieces, P.UNIGRAM, dummy_prefix=False)
    score = {p: s for p, s, _ in pieces}

    def best(text):
        cuts = [(sum(score.get(x, -1e9) for x in parts), parts) for m in range(2 ** (len(text) - 1)) for parts in [split(text, m)]]
        return max(cuts)[0]

    def split(text, mask):
        out = [text[0]]
        for i, c in enumerate(text[1:]):
            if mask >> i & 1:
                out.append(c)
            else:
                out[-1] += c
        return out

    for _ in range(60):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 9)))
        ids = model.segment(text)
        assert abs(sum(pieces[i][1] for i in ids) - best(text)) < 1e-9
    assert model.encode("abz").tolist()[-1] == 0 and model.encode("zzz").tolist() == [0]


def test_defined_cases(spark, model):
    data = P.read_model()
    docs = spark.createDataFrame([(1, None, 1), (None, "a b", 1), (2, "", 1), (2, "", 1), (3, "word " * 50_000, 1)], "doc_id long, text string, ids int")
    got = P.encode(docs, data)
    rows = sorted(got.collect(), key=str)
    assert len(rows) == 5
    for r in rows:
        assert (r.ids is None) == (r.doc_id == 1 and r.n_pieces == 0) and r.round_trip in ((None,) if r.doc_id == 1 else (True,))
    back = {(r.doc_id, r.text) for r in P.decode(got, data).collect()}
    assert back == {(r.doc_id, r.text) for r in docs.collect()}
    assert P.encode(docs.where("false"), data).count() == 0
    with pytest.raises(ValueError, match="range"):
        model.decode([10**6])
    with pytest.raises(ValueError, match="user-defined"):
        P.PieceModel([("x", 0.0, P.USER_DEFINED)], P.BPE)

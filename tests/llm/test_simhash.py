import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from eventpulse.llm import simhash as S
from eventpulse.llm.components import connected_components

SCHEMA = "doc_id long, text string, fp string, component_id string"


def plain(text):
    out = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in out.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps):
    """Brute force over all pairs. fps: {doc_id: fingerprint}."""
    root = {d: d for d in fps}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in ids}


def test_planes_cover_every_three_bytes():
    assert len(S.PLANES) == 14
    assert all(any(not set(p) & {a, b, c} for p in S.PLANES) for a in range(8) for b in range(8) for c in range(8))


@pytest.mark.parametrize("text", [None, "", " \n", "A", "a B", "One two  three", "x\ty z w v É é", "the cat sat on the mat " * 40])
def test_fingerprint(text):
    assert S.fingerprint_of(text.encode() if text else None) % 2**64 == plain(text)


def test_defined_cases(spark):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    texts = [(5, "same words in here"), (3, "Same words\tin here"), (9, None), (8, ""), (7, "\n"), (None, "same words in here"), (None, "alone at last"), (2, long), (4, long + " tail"), (5, "same words in here")]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in texts], SCHEMA)
    rows = S.near_duplicates(docs).collect()
    got = [(r.doc_id, r.component_id) for r in rows]
    assert sorted(got, key=str) == sorted([(5, 3), (3, 3), (9, 7), (8, 7), (7, 7), (None, 3), (None, None), (2, 2), (4, 2), (5, 3)], key=str)
    assert S.near_duplicates(docs.where("false")).count() == 0


@pytest.mark.parametrize("long_list", [S.LONG_LIST, 3])
def test_links_equal_brute_force(spark, long_list):
    rng = np.random.default_rng(1)
    seeds = rng.integers(0, 2**63, 12, dtype=np.uint64)
    fps = {}
    for d in range(600):
        x = int(seeds[rng.integers(len(seeds) if d % 3 else 1)])
        for b in rng.choice(64, rng.integers(0, 9), replace=False):
            x ^= 1 << int(b)
        fps[d] = x
    signed = [(x - 2**64 if x >> 63 else x, d) for d, x in fps.items()]
    distinct = spark.createDataFrame(signed, "fp long, first long").groupBy("fp").agg(F.min("first").alias("first"))
    lists = S.index(distinct, long_list).repartition(3, "combo", "key").sortWithinPartitions("combo", "key")
    roots = connected_components(lists.mapInPandas(lambda p: S._find(p, 3), "u long, v long"))
    of = distinct.join(roots, distinct["first"] == roots["u"], "left").select("fp", F.coalesce("v", "first").alias("c"))
    got = {r.fp % 2**64: r.c for r in of.collect()}
    assert {d: got[x] for d, x in fps.items()} == components(fps)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").toPandas()
    fps = {int(d): plain(t) for d, t in zip(docs.doc_id, docs.text)}
    want = components(fps)
    got = S.op9_simhash_near_dedup(spark, "/root/testdata/sf0.001").collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(d, f"{x:016x}", want[d]) for d, x in fps.items()}


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (None, 3)]
    got = {r.u: r.v for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 60)}


def test_components_put_together_from_chunks(spark, monkeypatch):
    from eventpulse.llm import components as K

    monkeypatch.setattr(K, "CHUNK", 7)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)]
    assert {r.u: r.v for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()} == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 60)}

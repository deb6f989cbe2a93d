import numpy as np
import pytest
from pyspark.sql import functions as F

from eventpulse.llm import topk as T

SCHEMA = "vec_id long, embedding array<float>, query long"


def code(x):
    return sum(1 << i for i, v in enumerate(x) if v is not None and v > 0)


def brute(rows, k):
    codes = {i: code(x) for i, x in rows if i is not None and x is not None and len(x) == 64}
    return {(q, n + 1, i, d) for q in codes if q % 20 == 0 for n, (d, i) in enumerate(sorted(((codes[q] ^ c).bit_count(), i) for i, c in codes.items() if i != q)[:k])}


def run(spark, rows, k, **more):
    frame = spark.createDataFrame([(i, x, 1) for i, x in rows], SCHEMA)
    return {tuple(r) for r in T.nearest(frame, F.pmod("vec_id", F.lit(20)) == 0, k, **more).collect()}


@pytest.mark.parametrize("near", [True, False])
def test_exact_in_any_blocks(spark, near):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=64)
    rows = [(i, (centre * near + rng.normal(size=64)).astype(np.float32).tolist()) for i in range(500)]
    rows += [(1000 + i, rows[20][1]) for i in range(90)]  # a group of equal codes
    assert run(spark, rows, 7) == run(spark, rows, 7, code_block=64, query_block=8) == brute(rows, 7)


def test_defined_cases(spark):
    ones = [1.0] * 64
    rows = [(0, ones), (0, ones), (1, ones), (None, ones), (2, None), (3, [1.0]), (4, [None, float("nan"), *ones[2:]]), (20, [-1.0] * 64)]
    got = run(spark, rows, 10)
    assert got == {(0, 1, 1, 0), (0, 2, 4, 2), (0, 3, 20, 64), (20, 1, 4, 62), (20, 2, 0, 64), (20, 3, 1, 64)}
    assert run(spark, [], 3) == set()
    with pytest.raises(ValueError, match="3 dimensions"):
        run(spark, [(0, [1.0] * 3), (1, None)], 3)


def test_segments_and_probes():
    assert [w for _, w in T.segments_of(51_000)] == [16] * 4 and sum(w for _, w in T.segments_of(500)) == 64 and len(T.segments_of(10**12)) == 2
    assert sorted(T._masks(2, 5).tolist()) == sorted(x for x in range(32) if x.bit_count() == 2)


def test_rounds_over_postings_alone_are_exact(spark, monkeypatch):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 64))
    rows = [(i, (3 * centres[i % 40] + rng.normal(size=64)).astype(np.float32).tolist()) for i in range(1200)]
    monkeypatch.setattr(T, "_search", lambda *a: 1 / 0)  # no query is left for the search over blocks
    assert run(spark, rows, 5) == brute(rows, 5)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert {tuple(r) for r in T.op5_multi_index_hashing_topk(spark, sf).collect()} == brute(rows, 10)


def test_probes_are_never_broadcast(spark):
    """A query makes thousands of probes, and their estimated size is that of the queries."""
    from eventpulse.llm.topk import _meeting, _probes

    pending = spark.range(20).selectExpr("id as query", "64L as kth")
    posted = spark.range(20).selectExpr("0 as segment", "id as value", "id as code")
    joined = _meeting(_probes(pending, [(0, 16)], 2), posted)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert joined.count() > 0

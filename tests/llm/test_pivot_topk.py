import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldnotes.llm import pivot_topk

SCHEMA = "vec_id bigint, embedding array<float>, label int, pivot string, dist string"


def brute(rows, k, scale=64):
    clean = [(i, [math.floor(scale * x) for x in np.array(v, np.float32).tolist()]) for i, v in rows
             if i is not None and v is not None and None not in v and all(map(math.isfinite, v))]
    out = []
    for q, a in clean:
        if q % 20 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in clean if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows, k=20):
    df = spark.createDataFrame([(i, v, 1, "p", "d") for i, v in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in pivot_topk.top_k(df, F.col("vec_id") % 20 == 0, k).collect())


def vectors(n, dim, seed, clusters=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.3, (clusters, dim))
    return [(i, (centres[rng.integers(clusters)] + rng.normal(0, 0.05, dim)).tolist()) for i in range(n)]


def test_like_brute_force(spark, monkeypatch):
    for name, value in (("CELL", 16), ("QUERIES", 4), ("BUNDLE", 2), ("SAMPLE", 80), ("PIVOTS", 7)):
        monkeypatch.setattr(pivot_topk, name, value)
    rows = vectors(500, 12, 1)
    assert run(spark, rows) == brute(rows, 20)


def test_odd_rows_ties_and_copies(spark):
    rows = vectors(90, 8, 2) + [(1000 + i, [0.5] * 8) for i in range(60)] + [
        (2000, None), (2020, [float("nan")] * 8), (2040, [None] + [0.1] * 7), (2060, [float("inf")] * 8),
        (None, [0.1] * 8), (2080, []), (2100, [0.7, -0.2]), (2120, [0.0] * 8)]
    assert run(spark, rows) == brute(rows, 20)


def test_few_rows_and_none(spark):
    rows = vectors(5, 4, 3)
    assert run(spark, rows) == brute(rows, 20)
    assert run(spark, [(0, [1.0, 2.0])]) == []
    assert run(spark, []) == []


def test_annuli_are_skipped_without_loss(spark, monkeypatch):
    monkeypatch.setattr(pivot_topk, "CELL", 32)
    rng = np.random.default_rng(4)
    rows = [(i, (np.eye(6)[i % 6] * 2 + rng.normal(0, 0.01, 6)).tolist()) for i in range(400)]
    assert run(spark, rows, 5) == brute(rows, 5)


def test_components_out_of_range(spark):
    with pytest.raises(Exception, match="out of range"):
        run(spark, [(0, [1e9]), (1, [1.0])])


def test_large_components_and_long_vectors(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.integers(-40_000, 40_000, 5) / 2).tolist()) for i in range(80)]
    assert run(spark, rows) == brute(rows, 20)
    rows = [(i, rng.normal(0, 1, 5000).astype(np.float32).tolist()) for i in range(50)]
    assert run(spark, rows, 5) == brute(rows, 5)


def test_repeated_query_ids_have_rankings_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(pivot_topk, "CELL", 8)
    rows = vectors(120, 8, 7)
    rows += [(20, rows[3][1]), (20, rows[20][1]), (40, rows[40][1]), (7, rows[7][1])]
    assert run(spark, rows) == brute(rows, 20)


def test_pairs_that_the_bound_excludes_fetch_no_vectors(spark, monkeypatch):
    for name, value in (("CELL", 16), ("QUERIES", 8), ("BUNDLE", 2)):
        monkeypatch.setattr(pivot_topk, name, value)
    rng = np.random.default_rng(8)
    rows = [(i, (np.eye(8)[i % 8] * 2 + rng.normal(0, 0.01, 8)).tolist()) for i in range(1600)]
    seen, plain = {}, pivot_topk.stage

    def counted(df, name):
        seen[name] = plain(df, name)
        return seen[name]

    monkeypatch.setattr(pivot_topk, "stage", counted)
    assert run(spark, rows, 5) == brute(rows, 5)
    assert seen["open-pairs"].count() < seen["annuli"].count() * seen["query-blocks"].count() / 4

"""One vote per tree, prefixes of a forest, Poisson draws, wide measures."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldnotes.operators import balance, forest, measures, parse, search, votes
from fieldnotes.plans import queries as q
from fieldnotes.plans.fixtures import OBS_SPEC
from tests.conftest import SF_SMALL


def walk(tree, x):
    """The class a tree gives, node by node."""
    node = tree[0]
    while node.feature >= 0:
        value = x[node.feature]
        left = value in node.categories if node.categories is not None else value <= node.threshold
        node = tree[node.left if left else node.right]
    return node.prediction


def test_every_tree_walked_by_hand(spark):
    """Deep trees over continuous and categorical features."""
    o, train, _ = q._obs_train_test(spark, SF_SMALL)
    params = forest.ForestParams(num_trees=7, max_depth=6, max_bins=32, seed=3)
    model = forest.train(train, OBS_SPEC, q.OBS_FEATURES, params)
    trees = votes.trees_of(model.stages[-1])
    assert len(trees) == 7
    assert any(n.categories is not None for t in trees for n in t.values())
    rows = votes.with_votes(votes.assembled(model, o), trees).select("sampling_id", "features", "votes").collect()
    want = {r["sampling_id"]: [walk(t, r["features"].toArray()) for t in trees] for r in rows}
    assert {r["sampling_id"]: r["votes"] for r in rows} == want
    scored = votes.score_by_votes(model, o, "sampling_id").collect()
    assert {r["sampling_id"]: r["prediction"] for r in scored} == {k: int(2 * sum(v) > len(v)) for k, v in want.items()}
    assert len({tuple(v) for v in want.values()}) > 3


def test_ties_go_to_the_smaller_class(spark):
    rows = spark.createDataFrame([([0, 1],), ([1, 1, 0, 0],), ([2, 2, 1],), ([2, 1],), ([0, 0, 1, 1, 2],)], "votes array<int>")
    got = [r[0] for r in rows.select(votes.majority(classes=3)).collect()]
    assert got == [0, 0, 2, 1, 0]


def test_prefixes_from_one_fit(spark, monkeypatch):
    train, holdout = balance.split(q._voters(spark, SF_SMALL), "event_id", salt="split")
    data = search.prepare(train, holdout, q.VOTE_SPEC, q.VOTE_FEATURES)
    fits = []
    make = forest.ForestParams.classifier
    monkeypatch.setattr(forest.ForestParams, "classifier", lambda self, **kw: fits.append(self.num_trees) or make(self, **kw))
    best, acc, trials, tuned = search.tune_trees(data, q.VOTE_FEATURES, q.STRONG_LAST, 1, 3)
    assert fits == [3] and tuned.num_trees == best and len(trials) == 3
    assert acc == max(t[3] for t in trials) == trials[best - 1][3]
    later = search.tune_trees(data, q.VOTE_FEATURES, q.STRONG_LAST, 2, 3)
    assert [t[3] for t in later[2]] == [t[3] for t in trials[1:]]
    with pytest.raises(ValueError):
        search.tune_trees(data, q.VOTE_FEATURES, q.STRONG_LAST, 0, 3)
    data.release()


@pytest.mark.parametrize("rate", [0.4, 1.0, 3.7, 30.0, 90.0])
def test_poisson_copies(spark, rate):
    """Mean, variance and share of zeros; the same draw on any partitioning."""
    rows = spark.range(20_000).withColumnRenamed("id", "key")
    got, copies = balance.poisson_copies(rows, "key", rate, "s")
    n = np.array([r[0] for r in got.select(copies).collect()])
    assert abs(n.mean() - rate) < 5 * math.sqrt(rate / 20_000)
    assert abs(n.var() - rate) < 0.06 * rate + 0.02
    assert abs((n == 0).mean() - math.exp(-rate)) < 0.02
    again, copies = balance.poisson_copies(rows.repartition(7), "key", rate, "s")
    drawn = {r[0]: r[1] for r in again.select("key", copies.alias("n")).collect()}
    assert [drawn[k] for k in range(20_000)] == n.tolist()


def test_poisson_quantiles_end_at_one():
    for rate in (0.1, 1.0, 32.0):
        reached = balance.poisson_quantiles(rate)
        assert reached == sorted(reached) and abs(reached[-1] - 1) < 1e-12 and reached[0] == math.exp(-rate)


def test_poisson_oversampling_keeps_columns_and_the_larger_class(spark):
    o = q.obs(spark, SF_SMALL)
    got = balance.oversample(o, key="event_id", method="poisson")
    assert got.columns == [*o.columns, "copy"]
    sizes = {r["label"]: r["n"] for r in balance.class_counts(o).collect()}
    large = max(sizes, key=sizes.get)
    after = {r["label"]: r["n"] for r in balance.class_counts(got).collect()}
    assert after[large] == sizes[large] and abs(after[1 - large] - sizes[large]) < 6 * math.sqrt(sizes[large])
    few = got.where((F.col("label_count") > 0).cast("int") != large)
    assert 0 < few.select("event_id").distinct().count() < sizes[1 - large]  # some are drawn 0 times


def test_wide_measures_are_the_sparse_ones_from_one_scan(spark):
    features = [f"w{i}" for i in range(60)]
    e = F.col("event_id")
    wide = q.table(spark, SF_SMALL, "events").select(
        F.when(e % 17 != 0, (e % 7).cast("double")).alias("y"),
        *[F.when((e + i) % 29 == 0, None).when((e + i) % 4 == 0, F.col("value") + 1e6 * (i % 2)).otherwise(0.0).alias(f"w{i}")
          for i in range(57)],
        F.lit(0.0).alias("w57"), F.lit(None).cast("double").alias("w58"), F.lit(2011.3).alias("w59"))
    got = measures.wide_measures(wide.repartition(5), features, "y")
    want = measures.sparse_measures(parse.sparse_cells(wide, features=features, label="y"), features, "y")
    a, b = ({r["feature"]: r for r in x.collect()} for x in (got, want))
    assert set(a) == set(b) == set(features)
    for f in features:
        assert a[f]["n"] == b[f]["n"]
        for c in ("mean", "score"):
            assert (a[f][c] is None) == (b[f][c] is None)
            assert a[f][c] is None or a[f][c] == pytest.approx(b[f][c], rel=1e-9, abs=1e-9)
    plan = measures.wide_measures(wide, features, "y")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    means = measures.wide_measures(wide, features)
    assert means.columns == ["feature", "n", "mean"] and means.count() == 60
    empty = measures.wide_measures(wide.limit(0), features, "y").collect()
    assert [(r["n"], r["score"]) for r in empty] == [(0, 0.0)] * 60

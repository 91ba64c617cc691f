"""Model tests: determinism, save/load, categorical handling, planted
"""

from pyspark.sql import functions as F

from fieldnotes.operators import balance, forest, search, vectors
from fieldnotes.plans.fixtures import OBS_SPEC, obs
from fieldnotes.session import scratch_path
from fieldnotes.sources import model_store
from tests.conftest import SF_MID, SF_SMALL

SMALL = forest.ForestParams(num_trees=5, max_depth=4, max_bins=32, seed=11)
FEATS = ["f_day", "f_hour", "f_effort", "f_kind"]


def _split(df):
    tagged = balance.hash_split(df, "event_id", salt="split")
    return (tagged.filter(F.col("part") == "train").drop("part"),
            tagged.filter(F.col("part") == "holdout").drop("part"))


def test_same_seed_same_predictions_and_roundtrip(spark):
    o = obs(spark, SF_SMALL)
    train, _ = _split(o)
    m1 = forest.train(train, OBS_SPEC, FEATS, SMALL)
    m2 = forest.train(train, OBS_SPEC, FEATS, SMALL)
    p1 = forest.score(m1, o, "sampling_id", "a")
    p2 = forest.score(m2, o, "sampling_id", "b")
    assert p1.join(p2, "sampling_id").filter(F.col("a") != F.col("b")).count() == 0
    path = scratch_path(spark, "test-model")
    model_store.save(spark, path, m1, OBS_SPEC, FEATS)
    loaded = model_store.load(spark, path)
    assert loaded.spec == OBS_SPEC and loaded.features == FEATS
    assert loaded.replace == {"f_day": -1.0, "f_hour": -1.0, "f_effort": -1.0}
    p3 = forest.score(loaded.pipeline, o, "sampling_id", "c")
    assert p1.join(p3, "sampling_id").filter(F.col("a") != F.col("c")).count() == 0
    cats = model_store.load_dictionary(spark, path)
    assert {r["category"] for r in cats.collect()} == {"click", "error", "purchase",
                                                       "signup", "view"}


def test_missing_category_gets_own_code(spark):
    o = obs(spark, SF_SMALL)
    stages, feats = vectors.vector_stages(OBS_SPEC, FEATS)
    from pyspark.ml import Pipeline
    model = Pipeline(stages=stages).fit(o)
    out = model.transform(o)
    arity = vectors.category_arity(out)
    pos = feats.index("f_kind")
    assert arity[pos] == 6          # 5 names + one code for missing / unseen
    miss = out.filter(F.col("f_kind").isNull()).select("f_kind__idx").distinct().collect()
    assert [r[0] for r in miss] == [5.0]
    # missing continuous cells become -1 in the vector
    row = out.filter(F.col("f_effort").isNull()).select("features").first()[0]
    assert row[feats.index("f_effort")] == -1.0


def test_selection_finds_planted_signal(spark):
    o = obs(spark, SF_MID).withColumn(
        "label_count", F.when(F.col("f_hour") >= 12, 1.0).otherwise(0.0))
    train, test = _split(o)
    data = search.prepare(train, test, OBS_SPEC, FEATS)
    try:
        chosen, acc, trials = search.greedy_selection(data, FEATS, SMALL, parallelism=2)
        assert chosen[0] == "f_hour" and acc > 0.95
        chosen_p, acc_p, _ = search.prefix_selection(
            data, ["f_hour", "f_day", "f_effort"], SMALL)
        assert "f_hour" in chosen_p and acc_p > 0.95
        best, acc_t, rows, tuned = search.tune(data, ["f_hour"], SMALL, "maxDepth", 1, 3)
        assert acc_t > 0.95 and tuned.max_depth == best and len(rows) == 3
    finally:
        data.release()


def test_prefix_range_option(spark):
    o = obs(spark, SF_SMALL)
    train, test = _split(o)
    data = search.prepare(train, test, OBS_SPEC, ["f_day", "f_hour"])
    try:
        _, _, full = search.prefix_selection(data, ["f_day", "f_hour"], SMALL)
        _, _, short = search.prefix_selection(data, ["f_day", "f_hour"], SMALL,
                                              include_last=False)
        assert len(full) == 2 and len(short) == 1
    finally:
        data.release()


def test_tune_rejects_unknown_kind(spark):
    import pytest
    with pytest.raises(ValueError):
        search.tune(None, [], SMALL, "impurity", 1, 2)

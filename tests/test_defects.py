
import os

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from fieldnotes.jobs import check_ids
from fieldnotes.operators import balance, forest, vectors
from fieldnotes.operators.parse import numeric_cells, parse
from fieldnotes.plans.fixtures import OBS_SPEC, obs
from fieldnotes.sources.csv import read_observations
from fieldnotes.spec import FeatureSpec
from tests.conftest import SF_SMALL
from tests.test_cells import HAND, SPEC, write


def test_d3_replacement_map_is_honoured(spark, tmp):
    wide = parse(read_observations(spark, write(tmp, "h.csv", HAND), SPEC), SPEC)
    stages, feats = vectors.vector_stages(SPEC, ["A", "B"], replace={"A": 99.0})
    out = Pipeline(stages=stages).fit(wide).transform(wide)
    vec = {r["ID"]: list(r["features"]) for r in out.select("ID", "features").collect()}
    assert vec["S102"][feats.index("A")] == 99.0      # A missing -> 99
    assert vec["S104"][feats.index("B")] == -1.0      # B missing -> default -1


def test_d5_unseen_category_scores_with_saved_dictionary(spark):
    train = spark.createDataFrame(
        [("k%d" % i, "a" if i % 2 else "b", float(i % 2)) for i in range(40)],
        "key string, kind string, y double")
    spec = FeatureSpec(columns=("key", "kind", "y"), label="y", key="key", discrete=("kind",))
    model = forest.train(train, spec, ["kind"],
                         forest.ForestParams(num_trees=2, max_depth=2, max_bins=8, seed=1))
    new = spark.createDataFrame([("n1", "c", None), ("n2", None, None)],
                                "key string, kind string, y double")
    assert forest.score(model, new, "key").count() == 2


def test_d7_seeded_random_sampling_repeats(spark):
    o = obs(spark, SF_SMALL)
    a = balance.undersample(o, method="random", seed=9).select("event_id")
    b = balance.undersample(o, method="random", seed=9).select("event_id")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_d12_label_is_never_a_vector_slot():
    feats = vectors.ordered_features(OBS_SPEC, ["f_day", "label_count", "f_kind"])
    assert feats == ["f_day", "f_kind"]


def test_d14_check_ids_fails_on_mismatch(spark, tmp, capsys):
    inp = os.path.join(tmp, "in")
    out = os.path.join(tmp, "out")
    spark.createDataFrame([(f"S{i}", i) for i in range(20)], "id string, v int") \
        .coalesce(1).write.option("header", True).csv(inp)
    spark.createDataFrame([(f"S{i}", 0) for i in [1, 0] + list(range(2, 20))],
                          "id string, p int").coalesce(1).write.option("header", True).csv(out)
    assert check_ids.main(["--input", inp, "--output", out]) == 1
    text = capsys.readouterr().out
    assert "n_mismatch=2" in text and "do not match" in text


def test_unpivot_count_is_rows_times_features_minus_missing(spark):
    o = obs(spark, SF_SMALL)
    feats = ["f_day", "f_hour", "f_effort", "label_count"]
    missing = o.select(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in feats]).first()
    cells = numeric_cells(o, OBS_SPEC, features=feats, with_label=False).count()
    assert cells == o.count() * len(feats) - sum(missing)

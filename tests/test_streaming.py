"""Scoring a folder of arriving files with a saved model (exactly-once
file sink; same predictions as the batch predict)."""

import os

from pyspark.sql import functions as F

from fieldnotes.operators import forest
from fieldnotes.operators.parse import parse
from fieldnotes.plans.fixtures import obs_raw, table
from fieldnotes.sources import model_store
from fieldnotes.spec import FeatureSpec
from fieldnotes.streaming.scoring import score_stream
from tests.conftest import SF_SMALL

SPEC = FeatureSpec(columns=("sampling_id", "f_day", "f_hour", "f_effort", "f_kind",
                            "label_count"),
                   label="label_count", key="sampling_id", id_cols=("sampling_id",),
                   discrete=("f_kind",))
FEATS = ["f_day", "f_hour", "f_effort", "f_kind"]


def test_score_stream_matches_batch(spark, tmp):
    raw = obs_raw(table(spark, SF_SMALL, "events")).drop("event_id")
    inbox = os.path.join(tmp, "inbox")
    raw.repartition(3).write.option("header", True).option("quote", "").csv(inbox)
    wide = parse(raw, SPEC)
    model = forest.train(wide, SPEC, FEATS, forest.ForestParams(num_trees=3, max_depth=3,
                                                                  max_bins=16, seed=5))
    model_dir = os.path.join(tmp, "model")
    model_store.save(spark, model_dir, model, SPEC, FEATS)

    out = os.path.join(tmp, "scored")
    q = score_stream(spark, inbox, out, model_dir, checkpoint=os.path.join(tmp, "ckpt"))
    q.awaitTermination(300)
    got = spark.read.option("header", True).schema(
        "SAMPLING_EVENT_ID string, SAW_AGELAIUS_PHOENICEUS int").csv(out)
    batch = forest.score(model, wide, "sampling_id")
    assert got.count() == raw.count()
    diff = got.join(batch, got.SAMPLING_EVENT_ID == batch.sampling_id) \
        .filter(F.col("SAW_AGELAIUS_PHOENICEUS") != F.col("prediction"))
    assert diff.count() == 0
    # a second run over the same folder adds nothing (files already seen)
    q2 = score_stream(spark, inbox, out, model_dir, checkpoint=os.path.join(tmp, "ckpt"))
    q2.awaitTermination(300)
    assert spark.read.option("header", True).csv(out).count() == raw.count()

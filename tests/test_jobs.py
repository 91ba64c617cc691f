"""Train -> predict -> id check -> sample, end to end on a CSV file made
from the events table (header, planted tokens)."""

import glob
import json
import os

from pyspark.sql import functions as F

from fieldnotes.jobs import check_ids, predict, sample, train
from fieldnotes.plans.fixtures import OBS_SPEC, obs_raw, table
from fieldnotes.sources import model_store
from tests.conftest import SF_SMALL


def _write_csv(spark, tmp):
    raw = obs_raw(table(spark, SF_SMALL, "events")).drop("event_id")
    out = os.path.join(tmp, "labeled")
    raw.coalesce(1).write.option("header", True).option("quote", "") \
        .option("compression", "bzip2").csv(out)
    return out, raw.count()


def test_train_predict_check(spark, tmp, capsys):
    src, n = _write_csv(spark, tmp)
    spec_path = os.path.join(tmp, "spec.json")
    spec = OBS_SPEC.__class__(
        columns=OBS_SPEC.columns[1:], label="label_count", key="sampling_id",
        id_cols=("sampling_id",), discrete=("f_kind",))
    with open(spec_path, "w") as fh:
        fh.write(spec.to_json())
    model_dir = os.path.join(tmp, "model")
    args = train.build_parser().parse_args(
        ["--input", src, "--output", model_dir, "--spec", spec_path, "--num-trees", "5",
         "--max-depth", "4", "--max-bins", "32"])
    result = train.run(spark, args)
    assert result["features"] == ["f_day", "f_hour", "f_effort", "f_kind"]
    assert 0.0 <= result["accuracy"] <= 1.0
    report = spark.read.parquet(model_store.current(spark, model_dir) + "/report").collect()
    assert {r["search"] for r in report} == {"final", "final:natural"}

    out = os.path.join(tmp, "predictions")
    predict.run(spark, predict.build_parser().parse_args(
        ["--input", src, "--output", out, "--model", model_dir]))
    preds = spark.read.option("header", True).csv(out)
    assert preds.columns == ["SAMPLING_EVENT_ID", "SAW_AGELAIUS_PHOENICEUS"]
    assert preds.count() == n
    assert {r[0] for r in preds.select("SAW_AGELAIUS_PHOENICEUS").distinct().collect()} <= {"0", "1"}

    assert check_ids.main(["--input", src, "--output", out]) == 0
    printed = capsys.readouterr().out
    assert "n_mismatch=0" in printed and "Sample ids match." in printed


def test_sample_job(spark, tmp, capsys):
    src, n = _write_csv(spark, tmp)
    out = os.path.join(tmp, "sampled")
    assert sample.main(["--input", src, "--output", out, "--rate", "0.2",
                        "--key", "sampling_id"]) == 0
    text = capsys.readouterr().out
    assert f"of {n} records" in text
    lines = [r[0] for r in spark.read.text(out).collect()]
    head = spark.read.text(src).first()[0]
    assert lines.count(head) == 1  # one header over all parts, and lines as they were
    kept = len(lines) - 1
    assert set(lines) <= {r[0] for r in spark.read.text(src).collect()}
    assert f"Sampled {kept} of" in text
    assert glob.glob(os.path.join(out, "*.bz2"))

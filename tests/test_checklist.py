"""The checklist layout end to end: header roles from the fixed lists,
job chosen by argument count, column pruning in the scoring scan."""

import os

from pyspark.sql import functions as F

from fieldnotes.jobs import predict, run
from fieldnotes.operators import forest
from fieldnotes.operators.parse import parse
from fieldnotes.plans.fixtures import table
from fieldnotes.sources import model_store
from fieldnotes.sources.csv import read_header, read_observations
from fieldnotes.spec import CHECKLIST_DEFAULT_FEATURES, checklist_spec, spec_for_header
from tests.conftest import SF_SMALL


def _checklist_csv(spark, tmp):
    """A checklist-shaped file derived from events (text cells, tokens)."""
    ev = table(spark, SF_SMALL, "events")
    eid, uid, val = F.col("event_id"), F.col("user_id"), F.col("value")
    txt = lambda c: c.cast("string")
    cols = {
        "SAMPLING_EVENT_ID": F.concat(F.lit("S"), txt(eid)),
        "LOC_ID": F.concat(F.lit("L"), txt(uid)),
        "COUNTRY": F.lit("US"),
        "PRIMARY_CHECKLIST_FLAG": F.lit("1"),
        "AGELAIUS_PHOENICEUS": F.when(uid % 10 == 3, "X").when(uid % 3 == 0, txt(eid % 5 + 1))
                                .otherwise("0"),
        "BCR": F.col("event_type"),
    }
    for i, name in enumerate(CHECKLIST_DEFAULT_FEATURES):
        cols[name] = F.when((eid + i) % 23 == 0, "?").when((eid + i) % 4 == 0, "0") \
            .otherwise(txt(F.round(val * (i + 1), 2)))
    for i in range(10):
        cols[f"SPECIES_{i}"] = F.when((eid + i) % 7 == 0, txt(uid % 4)).otherwise("0")
    raw = ev.select(*[c.alias(n) for n, c in cols.items()])
    out = os.path.join(tmp, "checklist")
    raw.coalesce(2).write.option("header", True).option("quote", "").csv(out)
    return out, raw.count()


def test_checklist_roles(spark, tmp):
    src, _ = _checklist_csv(spark, tmp)
    spec = checklist_spec(read_header(spark, src))
    assert spec.label == "AGELAIUS_PHOENICEUS" and spec.key == "SAMPLING_EVENT_ID"
    assert set(spec.excluded) == {"SAMPLING_EVENT_ID", "LOC_ID", "COUNTRY",
                                  "PRIMARY_CHECKLIST_FLAG", "BCR"}
    assert spec.predictors == CHECKLIST_DEFAULT_FEATURES
    wide = parse(read_observations(spark, src, spec), spec)
    assert "LOC_ID" not in wide.columns and "BCR" not in wide.columns


def test_run_by_argument_count_and_pruned_scan(spark, tmp):
    src, n = _checklist_csv(spark, tmp)
    model_dir = os.path.join(tmp, "model")
    assert run.main(["-", "4", src, model_dir]) == 0
    stored = model_store.load(spark, model_dir)
    assert stored.features == list(CHECKLIST_DEFAULT_FEATURES)
    out = os.path.join(tmp, "preds")
    assert run.main(["-", "4", src, out, model_dir]) == 0
    assert spark.read.option("header", True).csv(out).count() == n
    # the scoring scan decodes only the key and the model's columns
    spec = spec_for_header(stored.spec, read_header(spark, src))
    wide = parse(read_observations(spark, src, spec), spec)
    plan = forest.score(stored.pipeline, wide, spec.key)._jdf.queryExecution() \
        .executedPlan().toString()
    scan = plan[plan.index("FileScan csv [") + len("FileScan csv ["):]
    read = {c.split("#")[0] for c in scan[:scan.index("]")].split(",")}
    assert read == {"SAMPLING_EVENT_ID", *CHECKLIST_DEFAULT_FEATURES}
    assert "Exchange" not in plan


def test_rank_job_on_checklist(spark, tmp):
    from fieldnotes.jobs import rank
    src, _ = _checklist_csv(spark, tmp)
    out = os.path.join(tmp, "scores")
    assert rank.main(["--input", src, "--output", out]) == 0
    scores = spark.read.parquet(out)
    by = {(r["measure"], r["feature"]): (r["score"], r["rank"]) for r in scores.collect()}
    n_cont = len(CHECKLIST_DEFAULT_FEATURES) + 10      # + SPECIES_i
    assert sum(1 for m, _ in by if m == "pearson") == n_cont
    assert sum(1 for m, _ in by if m == "mean") == n_cont + 1   # the label has a mean
    ranks = sorted(r for (m, _), (_, r) in by.items() if m == "pearson")
    assert ranks == list(range(1, n_cont + 1))
    # same scores as the zero-filled plan on the same table
    spec = checklist_spec(read_header(spark, src))
    wide = parse(read_observations(spark, src, spec), spec)
    from fieldnotes.operators import measures
    from fieldnotes.operators.parse import numeric_cells
    zf = {r["feature"]: r["score"] for r in
          measures.pearson_scores(numeric_cells(wide, spec), spec.label).collect()}
    for f, s in zf.items():
        assert abs(by[("pearson", f)][0] - s) < 1e-9

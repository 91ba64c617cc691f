"""Measures against hand-computed numbers and independent computations."""

import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from fieldnotes.operators import measures
from fieldnotes.operators.parse import category_cells, numeric_cells, parse
from fieldnotes.plans.fixtures import OBS_SPEC, obs
from fieldnotes.sources.csv import read_observations
from tests.conftest import SF_SMALL
from tests.test_cells import HAND, SPEC, write


@pytest.fixture()
def hand(spark, tmp):
    return parse(read_observations(spark, write(tmp, "h.csv", HAND), SPEC), SPEC)


def test_means_by_hand(hand):
    got = {r["feature"]: (r["n"], r["mean"])
           for r in measures.feature_means(numeric_cells(hand, SPEC, with_label=False)).collect()}
    assert got["A"][0] == 5 and math.isclose(got["A"][1], 1.3)
    assert got["B"][0] == 5 and math.isclose(got["B"][1], 21.2)
    assert got["L"][0] == 5 and math.isclose(got["L"][1], 0.8)


def test_mode_by_hand(hand):
    m = measures.feature_modes(category_cells(hand, SPEC)).first()
    assert (m["feature"], m["mode"], m["mode_count"]) == ("KIND", "red", 2)


def test_mode_tie_goes_to_first_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",)], "k string")
    m = measures.feature_modes(category_cells(df, features=["k"])).first()
    assert (m["mode"], m["mode_count"]) == ("a", 2)


def _reference_pearson(xs, ys_present, ybar):
    x = np.array(xs, float)
    y = np.array(ys_present, float)
    n = len(x)
    xbar = x.mean()
    sx = math.sqrt((x * x).sum() / n - xbar * xbar)
    sy = math.sqrt((y * y).sum() / n - ybar * ybar)
    cov = (x * y).sum() / n - xbar * ybar
    return abs(cov / (sx * sy))


def test_pearson_variants_on_obs(spark):
    o = obs(spark, SF_SMALL)
    cells = numeric_cells(o, OBS_SPEC)
    default = {r["feature"]: r["score"]
               for r in measures.pearson_scores(cells, "label_count").collect()}
    pair = {r["feature"]: r["score"]
            for r in measures.pearson_scores(cells, "label_count", pairwise=True).collect()}
    assert set(default) == {"f_day", "f_hour", "f_effort"}
    pdf = o.select("f_effort", "f_hour", "label_count").toPandas()
    lab = pdf[pdf.label_count.notna()]
    ybar = lab.label_count.mean()
    eff = lab[lab.f_effort.notna()]
    want = _reference_pearson(eff.f_effort, eff.label_count, ybar)
    assert math.isclose(default["f_effort"], want, rel_tol=1e-9)
    want_pair = abs(np.corrcoef(eff.f_effort, eff.label_count)[0, 1])
    assert math.isclose(pair["f_effort"], want_pair, rel_tol=1e-9)
    # f_hour is never missing: both definitions agree
    assert math.isclose(default["f_hour"], pair["f_hour"], rel_tol=1e-9)
    # f_effort has missing cells: they differ (the label mean is over all rows)
    assert not math.isclose(default["f_effort"], pair["f_effort"], rel_tol=1e-6)


def test_pearson_constant_feature_is_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 1.0), (1.0, 2.0)], "x double, y double")
    got = measures.pearson_scores(numeric_cells(df, features=["x", "y"], label="y"), "y")
    assert got.first()["score"] == 0.0


def test_chi_squared_matches_ml_stat(spark):
    o = obs(spark, SF_SMALL).filter(F.col("label_count").isNotNull() & F.col("f_kind").isNotNull())
    ours = measures.chi_squared_scores(category_cells(o, OBS_SPEC)).first()["score"]
    kinds = sorted(r[0] for r in o.select("f_kind").distinct().collect())
    code = {k: float(i) for i, k in enumerate(kinds)}
    pts = [(Vectors.dense([code[r["f_kind"]]]), 1.0 if r["label_count"] > 0 else 0.0)
           for r in o.select("f_kind", "label_count").collect()]
    df = spark.createDataFrame(pts, ["features", "label"])
    theirs = ChiSquareTest.test(df, "features", "label").first()["statistics"][0]
    assert math.isclose(ours, theirs, rel_tol=1e-9)


def test_chi_squared_empty_class_is_null(spark):
    df = spark.createDataFrame([("a", 0.0), ("b", 0.0)], "k string, y double")
    got = measures.chi_squared_scores(category_cells(df, features=["k"], label="y"))
    assert got.first()["score"] is None


def test_rank_scores_order(spark):
    df = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.9), ("d", None)],
                               "feature string, score double")
    assert [r[0] for r in measures.rank_scores(df).collect()] == ["c", "a", "b", "d"]

"""
against plain-Python models, on generated inputs."""

import hashlib
import math
import re

from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldnotes.functions.cells import id_cell, numeric_cell
from fieldnotes.functions.hashing import uniform

TOKENS = st.sampled_from(["?", "X", "", "0", "0.0", "-0", "1.5", "-2", "1e2", "abc", "NaN",
                          " 3 ", "7x", "--1", "S101", "x12y34"])
NUMBERS = st.floats(allow_nan=False, allow_infinity=False, width=64).map(repr)
CELLS = st.lists(st.one_of(st.none(), TOKENS, NUMBERS), min_size=1, max_size=40)
SETTINGS = settings(max_examples=25, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def model_numeric(text):
    if text is None or text == "" or text.strip() == "":
        return 0.0
    if text == "?":
        return None
    if text == "X":
        return 0.0
    try:
        v = float(text)
    except ValueError:
        return None            # bad cell (on_error='null')
    return None if math.isnan(v) else v


def model_id(text):
    if text is None or text == "":
        return 0.0
    if text == "?":
        return None
    m = re.search(r"[0-9]+", text)
    return float(m.group(0)) if m else None


def _frame(spark, cells):
    return spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")


@SETTINGS
@given(cells=CELLS)
def test_numeric_cell_rules(spark, cells):
    df = _frame(spark, cells).select("i", numeric_cell("c", on_error="null").alias("v"))
    got = {r["i"]: r["v"] for r in df.collect()}
    for i, c in enumerate(cells):
        want = model_numeric(c)
        assert (got[i] is None and want is None) or got[i] == want, (c, got[i], want)


@SETTINGS
@given(cells=CELLS)
def test_id_cell_rules(spark, cells):
    df = _frame(spark, cells).select("i", id_cell("c", on_error="null").alias("v"))
    got = {r["i"]: r["v"] for r in df.collect()}
    for i, c in enumerate(cells):
        assert got[i] == model_id(c), (c, got[i])


@SETTINGS
@given(keys=st.lists(st.integers(min_value=-10**12, max_value=10**12), min_size=1,
                     max_size=40, unique=True))
def test_uniform_is_md5_prefix(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r["k"]: r["u"] for r in df.select("k", uniform("k", "s").alias("u")).collect()}
    for k in keys:
        h = hashlib.md5(f"{k}#s".encode()).hexdigest()[:13]
        assert got[k] == int(h, 16) / float(1 << 52)

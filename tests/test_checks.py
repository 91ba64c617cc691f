"""Positions, id-order check, curve extraction, name cleaning."""

from fieldnotes.operators import checks
from fieldnotes.spec import clean_names


def _metrics(df):
    return {r["metric"]: r["n"] for r in df.collect()}


def test_with_position_is_dense_and_ordered(spark):
    df = spark.range(0, 1000, numPartitions=7).withColumnRenamed("id", "k")
    pos = checks.with_position(df, ["k"]).collect()
    assert sorted((r["position"], r["k"]) for r in pos) == [(i, i) for i in range(1000)]


def test_id_order_check(spark):
    a = spark.createDataFrame([(i, f"S{i}") for i in range(10)], "o int, id string")
    same = checks.id_order_check(a, a, "id", ["o"], ["o"])
    assert _metrics(same) == {"n_input": 10, "n_output": 10, "n_mismatch": 0,
                              "n_missing": 0, "n_extra": 0}
    swapped = spark.createDataFrame([(i, f"S{j}") for i, j in
                                     enumerate([1, 0, 2, 3, 4, 5, 6, 7, 8])],
                                    "o int, id string")
    m = _metrics(checks.id_order_check(a, swapped, "id", ["o"], ["o"]))
    assert m["n_mismatch"] == 3 and m["n_missing"] == 1 and m["n_extra"] == 0


def test_extract_curve(spark):
    lines = spark.createDataFrame(
        [("depth 3: accuracy 0.61",), ("x depth 4: accuracy 0.7",), ("feature 5: accuracy 0.5",),
         ("depth 7: accuracy 0.9 tail",)], "value string")
    got = sorted(tuple(r) for r in
                 checks.extract_curve(lines, r"depth (\d+): accuracy (\d+\.\d+)").collect())
    assert got == [(3.0, 0.61), (7.0, 0.9)]


def test_clean_names():
    assert clean_names(["a b", "X", "x", "X1", "NLCD2006_FS", "nlcd2006 fs"]) == [
        "A_B", "X", "X1", "X2", "NLCD2006_FS", "NLCD2006_FS1"]


def test_prefix_sums_match_cumulative(spark):
    import random
    rnd = random.Random(3)
    rows = [(i, rnd.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "t int, v int").repartition(6)
    got = {r["t"]: (r["position"], r["v_before"], r["v_total"])
           for r in checks.prefix_sums(df, ["t"], ["v"]).collect()}
    run = 0
    total = sum(v for _, v in rows)
    for i, (t, v) in enumerate(rows):
        assert got[t] == (i, run, total)
        run += v

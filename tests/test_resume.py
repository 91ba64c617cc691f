"""Searches that are taken up again, model versions, headers in one pass and
positions on two levels."""

import os

import pytest
from pyspark.sql import functions as F

from fieldnotes.operators import checks, forest, search
from fieldnotes.operators.ledger import TrialLedger, fingerprint
from fieldnotes.sources import model_store
from fieldnotes.sources.csv import check_headers, first_lines
from fieldnotes.spec import FeatureSpec

SPEC = FeatureSpec(columns=("id", "a", "b", "y"), label="y", key="id")
SMALL = forest.ForestParams(num_trees=1, max_depth=1, max_bins=8)


def _rows(spark, n=60):
    return spark.createDataFrame([(f"k{i}", float(i % 2), float(i % 3), float(i % 2)) for i in range(n)],
                                 "id string, a double, b double, y double")


class Stopped(Exception):
    pass


def test_a_stopped_search_fits_only_what_is_missing(spark, tmp, monkeypatch):
    data = search.prepare(_rows(spark), _rows(spark, 20), SPEC, ["a", "b"])
    plain = search.greedy_selection(data, ["b", "a"], SMALL, parallelism=1)
    fit, fits = search.fit_eval, []

    def stopping(*args):
        if len(fits) == 2:
            raise Stopped
        fits.append(1)
        return fit(*args)

    monkeypatch.setattr(search, "fit_eval", stopping)
    with pytest.raises(Stopped):  # in the second round
        search.greedy_selection(data, ["b", "a"], SMALL, parallelism=1, ledger=TrialLedger(spark, f"{tmp}/trials"))
    monkeypatch.setattr(search, "fit_eval", fit)
    again = TrialLedger(spark, f"{tmp}/trials")
    assert search.greedy_selection(data, ["b", "a"], SMALL, parallelism=2, ledger=again) == plain
    assert again.fitted == len(plain[2]) - 2
    last = TrialLedger(spark, f"{tmp}/trials")
    assert search.greedy_selection(data, ["b", "a"], SMALL, ledger=last) == plain
    assert last.fitted == 0 and last.frame().count() == len(plain[2])
    # another configuration, seed or table is another trial
    other = TrialLedger(spark, f"{tmp}/trials")
    search.tune(data, ["a"], SMALL.with_(seed=SMALL.seed + 1), "maxDepth", 1, 2, ledger=other)
    assert other.fitted == 2
    more = search.prepare(_rows(spark, 62), _rows(spark, 20), SPEC, ["a", "b"])
    search.prefix_selection(more, ["a"], SMALL, ledger=other)
    assert other.fitted == 3
    data.release()
    more.release()


def test_fingerprints_follow_rows_not_order(spark):
    rows = _rows(spark)
    assert fingerprint(rows) == fingerprint(rows.orderBy(F.desc("id")).repartition(5))
    assert fingerprint(rows) != fingerprint(rows.union(rows.limit(1)))
    assert fingerprint(rows) != fingerprint(rows.withColumn("b", F.when(F.col("id") != "k7", F.col("b"))))
    assert fingerprint(rows.limit(0)) == "0:None"


def test_a_failed_save_leaves_the_model_before(spark, tmp, monkeypatch):
    path = f"{tmp}/m"
    with pytest.raises(FileNotFoundError):
        model_store.load(spark, path)
    model = forest.train(_rows(spark), SPEC, ["a", "b"], SMALL)
    model_store.save(spark, path, model, SPEC, ["a", "b"])
    other = forest.train(_rows(spark), SPEC, ["a"], SMALL)

    def fails(*args):
        raise Stopped

    with monkeypatch.context() as m:
        m.setattr(model_store, "dictionary_of", fails)  # between two parts
        with pytest.raises(Stopped):
            model_store.save(spark, path, other, SPEC, ["a"])
    assert model_store.load(spark, path).features == ["a", "b"]
    with monkeypatch.context() as m:
        m.setattr(model_store, "_publish", fails)  # all parts, no manifest
        with pytest.raises(Stopped):
            model_store.save(spark, path, other, SPEC, ["a"])
    assert model_store.load(spark, path).features == ["a", "b"]
    for _ in range(2):
        model_store.save(spark, path, other, SPEC, ["a"])
    assert model_store.load(spark, path).features == ["a"]
    assert len(model_store.versions(spark, path)) == model_store.KEPT_VERSIONS


def test_changed_and_missing_files_are_found(spark, tmp):
    path = f"{tmp}/m"
    model_store.save(spark, path, forest.train(_rows(spark), SPEC, ["a"], SMALL), SPEC, ["a"])
    model_store.check(spark, path)
    spec = os.path.join(model_store.current(spark, path), "spec")
    part = next(n for n in os.listdir(spec) if n.startswith("part-"))
    with open(os.path.join(spec, part), "a") as f:
        f.write(" ")
    os.remove(os.path.join(spec, f".{part}.crc"))
    with pytest.raises(ValueError, match="spec/part-"):
        model_store.load(spark, path)


def test_headers_of_many_files_in_one_pass(spark, tmp):
    os.makedirs(f"{tmp}/x")
    for i in range(12):
        with open(f"{tmp}/x/{i:02d}.csv", "w") as f:
            f.write("id,a\n" + "\n".join(f"{j},{i}" for j in range(2000 if i == 3 else 2)))
    open(f"{tmp}/x/empty.csv", "w").close()
    got = first_lines(spark, f"{tmp}/x").collect()
    assert len(got) == 12 and {r["line"] for r in got} == {"id,a"}
    check_headers(spark, f"{tmp}/x")
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    check_headers(spark, f"{tmp}/x")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs.getJobIdsForGroup("headers")) <= 3  # stages of one query, not one a file
    with open(f"{tmp}/x/05.csv", "w") as f:
        f.write("id,b\n1,2\n")
    with pytest.raises(ValueError, match=r"different headers.*00\.csv and .*05\.csv"):
        check_headers(spark, f"{tmp}/x")


@pytest.mark.parametrize("most", [100_000, 1])
def test_positions_beyond_the_broadcast_bound(spark, tmp, monkeypatch, most):
    monkeypatch.setattr(checks, "BROADCAST_ROWS", most)
    spark.range(500).select(F.format_string("%05d", "id").alias("value")).repartitionByRange(
        7, "value").sortWithinPartitions("value").write.text(f"{tmp}/t")
    scan = spark.read.text(f"{tmp}/t")
    got = checks.file_positions(scan)
    assert sorted((int(r["value"]), r["position"]) for r in got.collect()) == [(i, i) for i in range(500)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and ("BroadcastHashJoin" in plan or most == 1)
    some = checks.with_position(scan.repartition(9), ["value"])
    assert sorted((int(r["value"]), r["position"]) for r in some.collect()) == [(i, i) for i in range(500)]

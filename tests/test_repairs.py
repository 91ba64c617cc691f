"""Input that used to give wrong answers: empty columns, order of predictions,
restarts, missing keys, absent columns, headers, dictionaries."""

import os

import pytest
from pyspark.sql import functions as F

from fieldnotes import session
from fieldnotes.jobs import check_ids, predict, rank, run, train
from fieldnotes.operators import balance, forest, measures
from fieldnotes.operators.parse import sparse_cells
from fieldnotes.sources import model_store
from fieldnotes.sources.csv import read_observations
from fieldnotes.spec import FeatureSpec, checklist_spec, clean_names, spec_for_header
from fieldnotes.streaming.scoring import score_stream

SPEC = FeatureSpec(columns=("id", "a", "b", "zero", "gone", "const", "kind", "y"), label="y", key="id",
                   discrete=("kind",))


def lines(lo, hi):
    return [f"S{i},{i % 7},{i % 5}.5,0,?,2011.3,{'uv'[i % 2]},{i % 3 // 2}" for i in range(lo, hi)]


def write(path, rows, header=SPEC.columns):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write("\n".join([",".join(header), *rows]) + "\n")


@pytest.fixture()
def files(tmp):
    """Three files whose size order is not their name order."""
    write(f"{tmp}/in/a.csv", lines(0, 50))
    write(f"{tmp}/in/b.csv", lines(50, 900))
    write(f"{tmp}/in/c.csv", lines(900, 1000))
    spec = f"{tmp}/spec.json"
    with open(spec, "w") as out:
        out.write(SPEC.to_json())
    return f"{tmp}/in", spec


def fitted(spark, files, tmp):
    args = train.build_parser().parse_args(["--input", files[0], "--output", f"{tmp}/model", "--spec", files[1],
                                            "--num-trees", "2", "--max-depth", "2", "--max-bins", "8"])
    train.run(spark, args)
    return f"{tmp}/model"


def test_predictions_follow_the_input(spark, files, tmp, capsys):
    model = fitted(spark, files, tmp)
    for extra in ([], ["--partitions", "4"], ["--partitions", "4", "--single-file"]):
        out = f"{tmp}/preds{len(extra)}"
        predict.run(spark, predict.build_parser().parse_args(
            ["--input", files[0], "--output", out, "--model", model, *extra]))
        assert check_ids.main(["--input", files[0], "--output", out]) == 0
        assert "n_input=1000" in capsys.readouterr().out
    assert run.main(["-", "4", files[0], f"{tmp}/again", model]) == 0
    assert check_ids.main(["--input", files[0], "--output", f"{tmp}/again"]) == 0


def test_train_reads_the_raw_file_once_and_leaves_nothing(spark, files, tmp):
    root = session.checkpoint_root(spark)
    before = {p for p in os.listdir(f"{root}/fieldnotes")} if os.path.isdir(f"{root}/fieldnotes") else set()
    fitted(spark, files, tmp)
    after = set(os.listdir(f"{root}/fieldnotes")) if os.path.isdir(f"{root}/fieldnotes") else set()
    assert not {p for p in after - before if p.startswith("train-input")}


@pytest.mark.parametrize("extra", [[], ["--pairwise"], ["--features", "a,kind"]])
def test_rank_has_every_feature(spark, files, tmp, extra):
    assert rank.main(["--input", files[0], "--output", f"{tmp}/rank", "--spec", files[1], *extra]) == 0
    got = {(r["measure"], r["feature"]): r["score"] for r in spark.read.parquet(f"{tmp}/rank").collect()}
    wanted = {"a"} if "--features" in extra else {"a", "b", "zero", "gone", "const"}
    assert {f for m, f in got if m == "pearson"} == wanted
    assert {f for m, f in got if m == "mean"} == wanted | {"y"}
    if not extra:
        assert (got["mean", "zero"], got["mean", "gone"], got["pearson", "const"]) == (0.0, None, 0.0)


def test_sparse_measures_like_dense(spark):
    rows = [(float(i % 3), None if i % 5 == 0 else float(i % 4), 0.1, float(i % 7 > 4) if i % 9 else None) for i in range(200)]
    wide = spark.createDataFrame(rows, "a double, b double, c double, y double")
    from fieldnotes.operators.parse import numeric_cells
    feats = ["a", "b", "c", "y"]
    dense = {r["feature"]: r["score"] for r in measures.pearson_scores(
        numeric_cells(wide, features=feats, label="y"), "y", features=feats).collect()}
    sparse = {r["feature"]: r["score"] for r in measures.pearson_scores_sparse(
        sparse_cells(wide, features=feats, label="y"), "y", feats).collect()}
    assert dense.keys() == sparse.keys() == {"a", "b", "c"}
    assert all(abs(dense[f] - sparse[f]) < 1e-12 for f in dense) and dense["c"] == 0


def test_missing_keys_stop_a_draw(spark):
    df = spark.createDataFrame([(None, 0.0), ("k", 1.0), ("l", 0.0)], "key string, label_count double")
    for made in (balance.hash_split(df, "key"), balance.hash_sample(df, "key", 0.5), balance.undersample(df, "key")):
        with pytest.raises(Exception, match="NULL key"):
            made.collect()


def test_absent_columns_stop(spark):
    with pytest.raises(ValueError, match="doesn't have"):
        checklist_spec(["id", "AGELAIUS_PHOENICEUS", "A", "B"])
    with pytest.raises(ValueError, match="doesn't have"):
        spec_for_header(SPEC.with_features(["a", "b"]), ["id", "a", "kind", "y"])
    with pytest.raises(ValueError, match="doesn't have"):
        spec_for_header(SPEC, ["a", "b", "kind", "y"])
    assert spec_for_header(SPEC, ["id", "a", "kind"]).columns[-1] == "y"


def test_files_with_other_headers_stop(spark, tmp):
    write(f"{tmp}/x/a.csv", lines(0, 5))
    write(f"{tmp}/x/b.csv", lines(5, 9), ("id", "b", "a", *SPEC.columns[3:]))
    with pytest.raises(ValueError, match="different headers"):
        read_observations(spark, f"{tmp}/x", SPEC)


def test_saved_replacement_is_the_one_used(spark, files, tmp):
    wide = spark.createDataFrame([(f"k{i}", float(i), float(i % 2)) for i in range(30)], "id string, a double, y double")
    spec = FeatureSpec(columns=("id", "a", "y"), label="y", key="id", replace={"a": 3.0})
    model = forest.train(wide, spec, ["a"], forest.ForestParams(num_trees=1, max_depth=1, max_bins=8), replace={"a": 7.5})
    model_store.save(spark, f"{tmp}/m", model, spec, ["a"])
    assert model_store.load(spark, f"{tmp}/m").replace == {"a": 7.5}


def test_too_many_names_stop_before_the_fit(spark):
    wide = spark.createDataFrame([(f"k{i}", f"n{i}", float(i % 2)) for i in range(30)], "id string, kind string, y double")
    spec = FeatureSpec(columns=("id", "kind", "y"), label="y", key="id", discrete=("kind",))
    with pytest.raises(ValueError, match="'kind' has 30 names"):
        forest.train(wide, spec, ["kind"], forest.ForestParams(num_trees=1, max_depth=1, max_bins=16))


def test_restarted_scoring_goes_on(spark, files, tmp):
    model = fitted(spark, files, tmp)
    box, out, mark = f"{tmp}/box", f"{tmp}/scored", f"{tmp}/mark"
    for n, (lo, hi) in enumerate([(0, 50), (50, 90)]):
        write(f"{box}/f{n}.csv", lines(lo, hi))
        score_stream(spark, box, out, model, checkpoint=mark).awaitTermination(300)
        assert spark.read.option("header", True).csv(out).count() == hi
    with pytest.raises(TypeError):
        score_stream(spark, box, out, model)


def test_no_shared_folder_is_an_error(spark, monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_names_that_repeat_often():
    assert clean_names(["x", "x", "x", "x1", "X1", "a b", "n9", "n9", "n10"]) == [
        "X", "X1", "X2", "X3", "X4", "A_B", "N9", "N10", "N11"]
    got = clean_names(["x"] * 20_000 + ["x7"] * 3)
    assert len(set(got)) == 20_003 and got[19_999] == "X19999"
    assert clean_names(["NLCD2006_FS", "NLCD2006_FS"]) == ["NLCD2006_FS", "NLCD2006_FS1"]


def test_positions_over_files(spark, files):
    from fieldnotes.operators.checks import file_positions
    got = file_positions(spark.read.text(files[0])).select("position", F.split("value", ",")[0].alias("id")).collect()
    rows = sorted((r["position"], r["id"]) for r in got if r["id"] != "id")
    assert [i for _, i in rows] == [f"S{i}" for i in range(1000)]

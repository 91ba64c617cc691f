import zlib

import numpy as np
import pytest

from fieldnotes.llm import langid, quality_rules
from tests.llm.conftest import words

LETTERS = {"aa": "abcdefgh ", "bb": "opqrstuv ", "cc": "éèàçùmnw "}


def texts(n=240, seed=2):
    rng = np.random.default_rng(seed)
    langs = list(LETTERS)
    return [(i, "".join(rng.choice(list(LETTERS[langs[i % 3]]), 120)), langs[i % 3]) for i in range(n)]


def held(key, mod, rest):
    return zlib.crc32(str(key).encode()) % mod == rest


def test_language_of_held_out_texts(make):
    rows = texts()
    extra = [(1000, None, "aa"), (1001, "", "bb"), (1002, "123 -- \n", "cc"), (1003, "𝒳𝒴", "aa"),
             (1004, "abc" * 200_000, None), (5, texts()[5][1], "cc")]
    got = {(r["doc_id"], r["lang"]): r for r in langid.identify(make(rows + extra)).withColumn(
        "held", langid.held_out()).collect()}
    for i, _, lang in rows:
        r = got[i, lang]
        assert r["lang_pred"] == lang and 0.5 < r["score"] <= 1
        assert r["held"] == held(i, 4, 2)
    for i in (1000, 1001, 1002):
        r = next(v for (k, _), v in got.items() if k == i)
        assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert got[1004, None]["lang_pred"] == "aa"


def test_scores_like_plain_counting(make):
    model = langid.train(make(texts(60)))
    some = [texts(9, seed=8)[i][1] for i in range(9)] + ["é", "ab", "", "x" * 3000]
    langs, scores = model.score(some)
    for text, lang, score in zip(some, langs, scores):
        points, _ = langid.normalised([text])
        total = model.prior.copy()
        grams = 0
        for n in langid.GRAMS:
            h = langid.hashed(points, n)
            grams += len(h)
            total += model.weights[:, h].astype(float).sum(1)
        if not text:
            assert lang == "und"
            continue
        assert lang == model.languages[int(np.argmax(total))]
        soft = (total - model.prior) * min(1, langid.EVIDENCE / grams) + model.prior
        soft = np.exp(soft - soft.max())
        assert score == pytest.approx((soft / soft.sum())[model.languages.index(lang)], rel=1e-4)


def test_no_training_rows(make):
    got = langid.identify(make([(1, "abc", None), (2, None, None)])).collect()
    assert {r["lang_pred"] for r in got} == {"und"}
    assert langid.identify(make([])).collect() == []


def test_accepted_keeps_columns(make):
    docs = make(texts(60) + [(900, "12", "aa"), (901, None, "aa")])
    model = langid.train(docs)
    kept = langid.accepted(docs, model, langid.spread(docs, model))
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == set(range(60))


def junk(rng, kind):
    w = words(rng, 80).split()
    if kind == 0:
        return " ".join([w[0]] * 60 + [w[1]] * 40)
    if kind == 1:
        return " ".join(x + "%%%" for x in w)
    return " | ".join(w)


def quality_rows(n=900):
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        rows.append((i, junk(rng, int(rng.integers(0, 3))) if bad else words(rng, int(rng.integers(20, 200)))))
        labels.append((i, int(not bad), 0))
    return rows, labels


def test_quality_of_held_out_texts(spark, make):
    rows, labels = quality_rows()
    rows += [(5000, None), (5001, ""), (5002, "word " * 100_000), (3, rows[3][1])]
    labels += [(3, 1, 0), (7, None, 0), (None, 1, 0), (8, 5, 0)]
    marked = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = quality_rules.classify(make(rows), marked).collect()
    assert len(got) == len(rows)
    truth = {i: q for i, q, _ in labels[:900]}
    wrong = [r for r in got if r["doc_id"] in truth and r["predicted"] != truth[r["doc_id"]]]
    assert len([r for r in wrong if r["held_out"]]) <= 2
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == held(r["doc_id"], 5, 0)


def test_compiled_rules_score_like_numpy(spark, make):
    rows, labels = quality_rows(400)
    marked = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = quality_rules.train(make(rows), marked)
    assert 0 < len(model.rules) < 120 and model.describe()
    x = np.array([quality_rules.statistics_of(t) for _, t in rows])
    margin = model.bias + sum(w * quality_rules.holds(r, x) for r, w in model.rules)
    got = {r["doc_id"]: r["score"] for r in quality_rules.score(make(rows), model).collect()}
    assert [got[i] for i, _ in rows] == pytest.approx((1 / (1 + np.exp(-margin))).tolist())


def test_labels_of_one_kind_or_none(spark, make):
    rows = [(i, f"text {i}") for i in range(20)]
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r["score"] for r in quality_rules.classify(make(rows), none).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id bigint, quality int")
    assert {r["predicted"] for r in quality_rules.classify(make(rows), ones).collect()} == {1}
    assert quality_rules.classify(make([]), ones).collect() == []

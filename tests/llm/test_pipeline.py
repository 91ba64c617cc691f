"""The pipeline on a small corpus, each stage against a plain version on the
stage's own input."""
import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from fieldnotes.llm import langid, mixing, pii
from fieldnotes.llm.tokens import ChunkEncoder
from tests.llm.conftest import words
from tests.llm.test_minhash_join import brute
from tests.llm.test_pii import private


@pytest.fixture()
def folder(spark, tmp_path):
    rng = np.random.default_rng(21)
    rows = []
    for i in range(90):
        w = words(rng, int(rng.integers(20, 120))).split()
        if i % 4 == 0:
            w.insert(3, private(rng))
        text = " ".join(w)
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
        if i % 9 == 0:
            rows.append((500 + i, text.upper(), "en", "s0", len(text)))
    rows += [(900, None, "en", "s1", None), (901, "12 34", "en", "s1", 5), (902, "", None, None, 0)]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(path)
    return str(tmp_path)


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "pii", "mixing", "packing"]
    for k, (name, stage_of) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        out = f"{tmp_path}/out-{k}"
        stage_of(spark, docs, folder).write.parquet(out)
        docs = spark.read.parquet(out)
        after = docs.collect()
        if name != "packing":
            assert docs.columns == columns
        if name == "language_id":
            assert {r["doc_id"] for r in before} - {r["doc_id"] for r in after} == {900, 901, 902}
        elif name == "near_dedup":
            want = {r[0] for r in brute([(r["doc_id"], r["text"]) for r in before], 5, 80, 100) if r[3]}
            assert {r["doc_id"] for r in after} == want and len(after) == len(want) < len(before)
        elif name == "pii":
            assert len(after) == len(before)
            assert not any(pii.base_spans(r["text"]) for r in after)
            assert sum("<" in r["text"] for r in after) >= 15
            assert all(r["n_chars"] == len(r["text"]) for r in after)
        elif name == "mixing":
            sizes = {s: sum(len(r["text"].split()) for r in before if r["source"] == s) for s in ("s0", "s1", "s2")}
            for s, size in sizes.items():
                assert sum(len(r["text"].split()) for r in after if r["source"] == s) <= 2 * size
            total = sum(len(r["text"].split()) for r in after)
            assert 1.2 * sum(sizes.values()) < total <= 1.5 * sum(sizes.values())
        else:
            enc = ChunkEncoder(public_tokenizers.path("word_bpe_49k.json"))
            assert sum(r["length"] for r in after) == sum(len(enc.ids(r["text"])) + 1 for r in before)
            bins = {}
            for r in sorted(after, key=lambda r: (r["sequence_id"], r["offset"])):
                assert r["offset"] == bins.get(r["sequence_id"], 0)
                bins[r["sequence_id"]] = r["offset"] + r["length"]
            assert max(bins.values()) <= 2048


def test_run_is_the_stages_in_a_row(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert got.count() > 60 and "sequence_id" in got.columns
    again = corpus_pipeline.run(spark, folder)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(*key).collect())) == sorted(map(tuple, again.select(*key).collect()))


def test_stages_keep_clean_documents():
    assert langid.DEVIATIONS >= 6 and mixing.MOST == 2


def test_languages_not_learned_go(spark, make):
    """Texts in learned languages stay, long and short; two languages that no
    label has, letters at random and signs above the basic plane go."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs, ~langid.held_out())
    limits = langid.spread(docs, model, langid.held_out())
    assert set(limits) == set(model.languages)
    kept = langid.accepted(docs, model, limits).count()
    assert kept >= 0.995 * docs.count()
    rng = np.random.default_rng(3)
    russian = "Все люди рождаются свободными и равными в своём достоинстве и правах. Они наделены разумом и совестью. " * 2
    japanese = "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。" * 4
    noise = " ".join("".join(rng.choice(list("qxzjkwvy"), 9)) for _ in range(60))
    texts = docs.where("lang = 'en'").limit(3).collect()
    rows = [(1, russian), (2, japanese), (3, noise), (4, "🙂🙃 🚀" * 30), (5, None)] + [(10 + i, r["text"]) for i, r in enumerate(texts)]
    got = langid.accepted(make(rows), model, limits)
    assert {r["doc_id"] for r in got.collect()} == {10, 11, 12}
    assert langid.accepted(make([]), model, limits).collect() == []

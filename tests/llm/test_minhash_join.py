import re
from collections import Counter

import numpy as np
import pytest

from fieldnotes.llm import common, links, minhash_join
from fieldnotes.llm.components import components
from tests.llm.conftest import words

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingled(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    n = min(size, len(w))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else frozenset()


def brute(rows, size, num, den):
    sets = [shingled(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    by = {}
    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in by.get(x, ())).items():
            if den * n >= num * (len(s) + len(sets[j]) - n):
                up[top(i)] = top(j)
        for x in s:
            by.setdefault(x, []).append(i)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), k), k)
    return sorted((k, len(sets[i]), least[top(i)], k == least[top(i)]) for i, (k, _) in enumerate(rows))


def corpus(seed, n=60):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        w = words(rng, int(rng.integers(3, 250)), 4000).split()
        for copy in range(int(rng.integers(1, 6))):
            c = list(w)
            for at in rng.integers(0, len(c), int(rng.integers(0, max(1, len(c) // 20)))):
                c[at] = "edit" + str(rng.integers(100))
            rows.append((len(rows), " ".join(c) if copy % 2 else "\t".join(c).title()))
    return rows + [(5000, None), (5001, ""), (5002, " \n"), (5003, "one"), (5004, "ONE"), (5005, "one two"),
                   (5006, "one two three"), (5007, "one  two\x0bthree"), (5008, "É x"), (5009, "é x"), (3, rows[3][1])]


@pytest.mark.parametrize("seed,size,num,den", [(1, 3, 85, 100), (2, 5, 80, 100)])
def test_like_brute_force(make, seed, size, num, den):
    rows = corpus(seed)
    got = minhash_join.near_duplicates(make(rows), size, num, den).collect()
    assert sorted(map(tuple, got)) == brute(rows, size, num, den)


def test_a_large_group_in_blocks(make, monkeypatch):
    """Copies of one text, edited little and much: few links are near the
    limit, and the group is larger than a block."""
    monkeypatch.setattr(links, "BLOCK", 16)
    rng = np.random.default_rng(3)
    w = words(rng, 150, 4000).split()
    rows = []
    for i in range(120):
        c = list(w)
        for at in rng.integers(0, len(c), int(rng.integers(0, 12))):
            c[at] = f"e{rng.integers(10_000)}"
        rows.append((i, " ".join(c)))
    got = minhash_join.near_duplicates(make(rows), 3, 85, 100).collect()
    want = brute(rows, 3, 85, 100)
    assert sorted(map(tuple, got)) == want
    assert 1 < len({r[2] for r in want}) < 110


def test_set_hash_has_two_halves():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 63, int(n)).astype(np.uint64)) for n in rng.integers(1, 9, 500)]
    for k in (0, 1):
        assert len({minhash_join.set_hash(s)[k] for s in sets}) == 500
    assert all(minhash_join.set_hash(s)[0] != minhash_join.set_hash(s)[1] for s in sets)


def test_pigeonhole_of_keys():
    rng = np.random.default_rng(7)
    a = rng.integers(0, 1 << 32, (200, minhash_join.LONG), dtype=np.uint32)
    b = a.copy()
    for row in b:  # fewer than two errors per chunk on average: a chunk has at most one
        row[rng.permutation(minhash_join.SYMBOLS)[:2 * minhash_join.CHUNKS - 1]] += np.uint32(1)
    ka, kb = minhash_join.chunk_keys(a), minhash_join.chunk_keys(b)
    assert all(set(x) & set(y) for x, y in zip(ka.tolist(), kb.tolist()))


def test_words_hash_by_content():
    h = minhash_join.word_hashes("The the THE\tother\x0bThe\x85x é É")
    assert len(h) == 7 and h[0] == h[1] == h[2] and h[3] != h[0] and h[5] != h[6]
    long = minhash_join.word_hashes("w " * 200_000 + "x" * 50_000)
    assert len(long) == 200_001 and len(set(long.tolist())) == 2


def test_keep_one_of_each_group(make):
    rows = corpus(4, 30)
    docs = make(rows)
    kept = minhash_join.keep_one(docs)
    assert kept.columns == docs.columns
    want = {r[0] for r in brute(rows, 5, 80, 100) if r[3]}
    got = [r["doc_id"] for r in kept.collect()]
    assert sorted(got) == sorted(want)


def test_keep_one_leaves_texts_where_they_lie(make, spark):
    """Whole rows are not shuffled to the verdicts on them, whatever Spark takes the size of these to be."""
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = minhash_join.keep_one(make([(1, "one two three four five six"), (2, "One two three four five six"), (3, "other words")]))
        plan = kept._jdf.queryExecution().executedPlan().toString()
        got = sorted(r["doc_id"] for r in kept.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert got == [1, 3]


def test_keep_one_with_repeated_and_null_ids(make):
    """One row of each text stays under a repeated id that is kept; rows of NULL ids stay unless a smaller id names them."""
    a, b, c = ("one two three four five six", "seven eight nine ten eleven twelve", "red green blue black white grey")
    rows = [(1, a), (1, a), (1, b), (2, b), (3, c), (3, a), (None, c), (None, ""), (None, ""), (4, "")]
    got = sorted(((r["doc_id"], r["text"]) for r in minhash_join.keep_one(make(rows)).collect()), key=str)
    assert got == sorted([(1, a), (1, b), (3, c), (3, a), (None, c), (None, ""), (None, ""), (4, "")], key=str)


def test_empty_table(make):
    assert minhash_join.near_duplicates(make([])).collect() == []
    assert minhash_join.keep_one(make([])).collect() == []


def test_components_of_chains_stars_and_rings(spark):
    chains = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chains, "a bigint, b bigint")).collect()}
    assert {n for n in got if got[n] == 0} == set(range(41))
    assert {n for n in got if got[n] == 100} == set(range(100, 140))
    assert {n for n in got if got[n] == 200} == {200, 201, 202}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_repeated_rows_null_and_hot_keys(make):
    """One doc_id on a third of all rows, with equal and with other texts;
    NULL keys; rows that repeat key and text."""
    rng = np.random.default_rng(11)
    own = [(i, words(rng, 40, 4000)) for i in range(30)]
    hot = [(7, own[3][1])] * 10 + [(7, words(rng, 40, 4000)) for _ in range(10)]
    rows = own + hot + own[:5] + [(100 + i, t + " more") for i, (_, t) in enumerate(own[:10])]
    got = minhash_join.near_duplicates(make(rows), 3, 85, 100).collect()
    assert sorted(map(tuple, got)) == brute(rows, 3, 85, 100)
    text = words(rng, 40, 4000)
    lone = minhash_join.near_duplicates(make([(None, text), (None, text), (9, text + " more"), (None, "x")]), 3, 85, 100)
    assert sorted((r["component_id"] or -1) for r in lone.collect()) == [-1, 9, 9, 9]


def test_entries_are_the_keys_of_the_signature(make, spark):
    rng = np.random.default_rng(5)
    texts = [words(rng, 60, 4000) for _ in range(20)]
    rows = minhash_join.features(make(list(enumerate(texts))), 5).withColumnRenamed("doc_id", "node")
    got = {}
    for r in minhash_join._entries(rows).collect():
        got.setdefault(r["node"], []).append(r["key"])
    for i, t in enumerate(texts):
        sig = minhash_join.signature(minhash_join.shingles(t, 5))
        assert sorted(got[i]) == sorted(set(minhash_join.chunk_keys(sig[None]).view(np.int64).ravel().tolist()))


def test_joins_without_broadcast_give_the_same(make, monkeypatch):
    monkeypatch.setattr(common, "MOST_SENT", 0)
    rows = corpus(6, 20)
    got = minhash_join.near_duplicates(make(rows), 3, 85, 100).collect()
    assert sorted(map(tuple, got)) == brute(rows, 3, 85, 100)

import numpy as np
import pytest

from fieldnotes.llm import links, ngram_join
from tests.llm.conftest import words
from tests.llm.test_minhash_join import brute, corpus


def classes(rows, size, num, den):
    return [r[:3] for r in brute(rows, size, num, den)]


def joined(docs, size=4, num=85, den=100):
    return sorted(map(tuple, ngram_join.similar_classes(docs, size, num, den).collect()))


def edited(seed, n=120, most=12):
    """Copies of one text, edited little and much."""
    rng = np.random.default_rng(seed)
    w = words(rng, 150, 4000).split()
    rows = []
    for i in range(n):
        c = list(w)
        for at in rng.integers(0, len(c), int(rng.integers(0, most))):
            c[at] = f"e{rng.integers(10_000)}"
        rows.append((i, " ".join(c)))
    return rows


@pytest.mark.parametrize("seed,size,num,den", [(1, 4, 85, 100), (2, 5, 80, 100), (3, 2, 50, 100)])
def test_like_brute_force(make, seed, size, num, den):
    rows = corpus(seed)
    assert joined(make(rows), size, num, den) == classes(rows, size, num, den)


def test_small_units_ranges_and_blocks(make, monkeypatch):
    """Many units, hash ranges, heavy tokens and blocks, and copies left out
    without a broadcast, give the same rows."""
    for module, name, value in ((ngram_join, "UNIT", 900), (ngram_join, "PART", 700), (ngram_join, "HEAVY", 3),
                                (ngram_join, "BROADCAST_ROWS", 0), (links, "BLOCK", 16)):
        monkeypatch.setattr(module, name, value)
    rows = edited(3, most=5) + [(1000 + k, t) for k, t in edited(4, 40, 30)] + [(2000 + k, t) for k, t in corpus(5, 20) if k < 1000]
    want = classes(rows, 4, 85, 100)
    assert joined(make(rows)) == want
    assert 1 < len({r[2] for r in want}) < len(rows) - 60


def test_passages_that_many_share_and_hot_keys(make):
    """A third of all rows has one doc_id, a third one text, and all share a
    passage that makes up most of the short ones."""
    rng = np.random.default_rng(9)
    passage = words(rng, 60, 4000)
    rows = [(7, passage + " " + words(rng, int(rng.integers(0, 60)), 4000)) for _ in range(60)]
    rows += [(100 + i, passage + " end") for i in range(60)]
    rows += [(300 + i, words(rng, int(rng.integers(0, 12)), 4000) + " " + passage) for i in range(60)]
    assert joined(make(rows)) == classes(rows, 4, 85, 100)


def test_null_keys_long_texts_and_an_empty_table(make):
    rng = np.random.default_rng(2)
    long = words(rng, 60_000, 40_000)
    got = joined_by_text = ngram_join.similar_classes(make(
        [(None, "a b c d e f"), (5, long), (3, long + " more"), (None, "alone here now"), (9, "A B c d\ne f"), (4, "")])).collect()
    by = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in got}
    assert len(joined_by_text) == 6
    assert by[(None, 3)] == 9 and by[(9, 3)] == 9 and by[(None, 1)] is None and by[(4, 0)] == 4
    assert {c for (k, n), c in by.items() if n > 50_000} == {3}
    assert ngram_join.similar_classes(make([])).collect() == []


def test_matches_asked_for_grow_with_the_cost():
    rare, common = np.full(60, 2), np.full(60, 2000)
    assert ngram_join.matches(rare, 60, 51) == ngram_join.matches(common, 60, 51)  # the same for any one count
    rising = np.concatenate([np.full(12, 2), np.full(48, 5000)])
    assert ngram_join.matches(rising, 60, 51) < ngram_join.matches(rare, 60, 51)
    assert 1 <= ngram_join.matches(np.full(1, 5), 1, 1) <= 1
    long = ngram_join.matches(np.full(1000, 3), 1000, 850)
    assert long > ngram_join.matches(rare, 60, 51)


def test_a_prefix_holds_the_matches(make, spark):
    """Any two linked texts share the smaller number of matches of their prefixes."""
    rows = edited(11, 40, 8)
    docs = spark.createDataFrame([(str(k).rjust(16, "0").encode(), t) for k, t in rows], "hash binary, text string")
    got = {int(r["hash"]): r for r in ngram_join.prefixes(docs, 3, 4, 85, 100).collect()}
    sets = {k: set(ngram_join.shingles(t, 4).tolist()) for k, t in rows}
    for a in sets:
        assert got[a]["n"] == len(sets[a])
        for b in sets:
            if a != b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = got[a], got[b]
                both = set(np.frombuffer(x["sketch"], np.uint64).tolist()) & set(np.frombuffer(y["sketch"], np.uint64).tolist())
                assert len(both) >= min(x["need"], y["need"]) >= 1
                assert set(np.frombuffer(x["full"], np.uint64).tolist()) >= sets[a] & sets[b]

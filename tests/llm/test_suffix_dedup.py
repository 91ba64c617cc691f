import hashlib
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldnotes.llm import suffix_dedup
from tests.llm.conftest import words

L = suffix_dedup.LENGTH


def brute(rows):
    data = [(k, (t or "").encode()) for k, t in rows]
    seen = Counter(t[i:i + L] for _, t in data for i in range(len(t) - L + 1))
    out = []
    for k, t in data:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - L + 1):
            if seen[t[i:i + L]] > 1:
                gone[i:i + L] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((k, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(make, rows, **kw):
    got = suffix_dedup.remove_repeats(make(rows), **kw).collect()
    return sorted((tuple(r)[:5] for r in got), key=str)


def corpus(seed=6):
    rng = np.random.default_rng(seed)
    t = [words(rng, int(rng.integers(40, 400)), 4000) for _ in range(30)]
    passage = words(rng, 200, 4000)
    rows = list(enumerate(t))
    rows += [(100, t[0]), (101, t[0]), (102, t[1][:900] + "!" + t[1][900:]), (103, "x" + t[2] + "y")]
    for n in (398, 399, 400, 401, 600):  # a passage of about the length, in different surroundings
        rows += [(200 + n, words(rng, 50) + "<" + passage[:n] + ">" + words(rng, 60)),
                 (900 + n, words(rng, 30) + "[" + passage[:n] + "]" + words(rng, 60))]
    rows += [(300, t[3][:700] + " mid " + t[3][:700]), (301, "ab" * 600), (302, "é" * 500), (303, "Ti " * 300),
             (304, None), (305, ""), (306, "short"), (None, t[4]), (7, t[7]), (7, t[7]), (8, "other text " + t[8][5:])]
    return rows


def test_like_brute_force(make):
    rows = corpus()
    assert run(make, rows) == brute(rows)


def test_exact_way_for_very_large_buckets(make, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MOST", 1)
    rows = corpus(9)
    assert run(make, rows) == brute(rows)


def test_small_runs_of_buckets(make, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RUN_BYTES", 1)
    rows = corpus(10)
    assert run(make, rows) == brute(rows)


def test_a_common_passage_in_many_texts(make):
    rng = np.random.default_rng(12)
    passage = words(rng, 90, 4000)
    rows = [(i, words(rng, 20) + passage + words(rng, 20)) for i in range(120)]
    assert run(make, rows) == brute(rows)


def test_kept_bytes(make):
    rows = corpus(11)
    got = suffix_dedup.remove_repeats(make(rows), with_text=True).select("kept_sha256", "kept", "n_bytes", "n_removed").collect()
    assert len(got) == len(rows)
    for r in got:
        assert hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"]
        assert len(r["kept"]) == r["n_bytes"] - r["n_removed"]


def test_empty_table(make):
    assert run(make, []) == []


@pytest.mark.parametrize("seed", range(4))
def test_ranks_find_equal_suffixes(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 3, 700, dtype=np.uint8)
    bodies, before, starts = [], [], []
    for _ in range(12):
        b = base.copy()
        b[rng.integers(0, 700, int(rng.integers(0, 3)))] = 9
        first, last = sorted(rng.integers(0, 240, 2).tolist())
        bodies.append(b[first:last + L].tobytes())
        before.append(240 - first)
        starts.append(last - first + 1)
    bucket = np.arange(12) // 7
    got = suffix_dedup.repeated_starts(bodies, bucket, np.array(before), np.array(starts))
    seen = Counter((bucket[i], b[s:s + L], s - before[i]) for i, b in enumerate(bodies) for s in range(starts[i]))
    for i, b in enumerate(bodies):
        assert got[i].tolist() == [seen[bucket[i], b[s:s + L], s - before[i]] > 1 for s in range(starts[i])]


def test_memory_of_sorting_a_bucket():
    """A few numbers for each byte: two tasks with the largest buckets share an executor."""
    rng = np.random.default_rng(3)
    bodies = [rng.integers(0, 4, 120 + L - 1, dtype=np.uint8).tobytes() for _ in range(2000)]
    bodies[1::2] = bodies[::2]
    args = bodies, np.zeros(2000, np.int64), np.full(2000, 60), np.full(2000, 120)
    suffix_dedup.repeated_starts(*args)
    tracemalloc.start()
    try:
        found = suffix_dedup.repeated_starts(*args)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert all(f.all() for f in found)
    assert peak < 60 * sum(map(len, bodies))


def test_cover_is_a_difference_cover():
    p = suffix_dedup.PERIOD
    assert {(a - b) % p for a in suffix_dedup.COVER for b in suffix_dedup.COVER} == set(range(p))


def test_null_keys_are_kept_apart(make):
    docs = make([(None, None), (None, "a")])
    assert suffix_dedup.remove_repeats(docs).where(F.col("doc_id").isNull()).count() == 2

import hashlib

import numpy as np
import pytest

from fieldnotes.llm import syncmers
from tests.llm.conftest import words


def run(make, docs, **kw):
    return syncmers.fingerprints(make(docs), **kw).collect()


def sample(n=90):
    rng = np.random.default_rng(5)
    rows = [(i * 7 % 1000, words(rng, int(rng.integers(1, 400)))) for i in range(n)]
    return rows + [(2000, None), (2001, ""), (2002, "x"), (2003, "short text"), (2004, "é𝒳 " * 30), (2005, "ab" * 40_000)]


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""), reverse=True)
    out = []
    for i, (k, t) in enumerate(order):
        t, u = t or "", order[(i + 1) % len(order)][1] or ""
        e = syncmers.edited(t, u)
        a, b, c = syncmers.sketch(t), syncmers.sketch(e), syncmers.sketch(u)
        out.append((k, len(t), hashlib.sha256(e.encode()).hexdigest(), syncmers.to_string(a), syncmers.to_string(b),
                    syncmers.likeness(a, b), syncmers.likeness(a, c)))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [7, 1000])
def test_like_one_sorted_list(make, size):
    rows = sample() + [(None, "no key at all, but some text"), (4, "same key"), (4, "same key too")]
    assert sorted(map(tuple, run(make, rows, rows=size)), key=str) == brute(rows)


def test_likeness_follows_the_shared_half(make):
    rng = np.random.default_rng(8)
    got = run(make, [(i, words(rng, 300, 4000)) for i in range(40)])
    for r in got:
        assert 0.1 < r["near_edited"] < 0.65 and r["near_next"] < 0.1


def test_equal_texts_single_row_and_none(make):
    got = run(make, [(1, "the same text again and again"), (2, "the same text again and again")])
    assert got[0]["fingerprint"] == got[1]["fingerprint"] and {r["near_next"] for r in got} == {1.0}
    one = run(make, [(9, "all alone here with some words in it")])
    assert one[0]["near_next"] == 1.0 and one[0]["near_edited"] <= 1.0
    assert run(make, []) == []


def slow_anchors(text, k=syncmers.K, s=syncmers.S):
    """By definition: the least inner substring at the first or last place."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    h = [int(x) for x in syncmers._mix(syncmers._windows(points, s))]
    return [i for i in range(len(text) - k + 1) if min(h[i:i + k - s + 1]) in (h[i], h[i + k - s])]


def test_anchors_are_closed_syncmers():
    rng = np.random.default_rng(1)
    for text in (words(rng, 60), "a" * 60, "é𝒳b" * 30, words(rng, 4)[:24].ljust(24, "x")):
        places, hashes = syncmers.anchors(text)
        assert places.tolist() == slow_anchors(text)
        again, h2 = syncmers.anchors("zz" + text)  # context-free
        shared = dict(zip((again - 2).tolist(), h2.tolist()))
        assert all(shared[p] == h for p, h in zip(places.tolist(), hashes.tolist()))
        assert syncmers.to_string(syncmers.from_string(syncmers.to_string(syncmers.sketch(text)))) == \
            syncmers.to_string(syncmers.sketch(text))


def slow_sets(text):
    """By definition, as substrings with their first places: closed syncmers,
    in short texts of two sizes, or else the whole text."""
    out = {}
    for k, s in [(24, 8), (8, 4)][:1 + (len(text) < 78)]:
        h = [int(x) for x in syncmers._mix(syncmers._windows(
            np.array([ord(c) + 1 for c in text], np.uint64), s))] if len(text) >= k else []
        for i in range(len(text) - k + 1):
            if min(h[i:i + k - s + 1]) in (h[i], h[i + k - s]):
                out.setdefault(text[i:i + k], i)
    return out or ({text: 0} if text else {})


def slow_likeness(a, b):
    a, b = slow_sets(a), slow_sets(b)
    if not a or not b:
        return float(a == b)
    moved = {x: b[x] - a[x] for x in a if x in b}
    middle = np.median(list(moved.values())) if moved else 0
    room = 32 + 0.1 * max(*a.values(), *b.values())
    return sum(abs(m - middle) <= room for m in moved.values()) / len({*a, *b})


def test_short_texts_like_the_definition(make):
    rng = np.random.default_rng(3)
    texts = [words(rng, 30)[:n] for n in [0, 1, 7, 9, *range(24, 61), *range(24, 61), 77, 78]]
    got = {r["doc_id"]: r for r in run(make, list(enumerate(texts)))}
    for i, text in enumerate(texts):
        following = texts[i - 1]  # descending keys; the first one's is the last
        half = len(text) // 2
        other = text[:len(text) - half] + following[:half]
        assert (got[i]["fingerprint"] == "") == (text == "")
        assert len(got[i]["fingerprint"].split(",")) == max(1, len(slow_sets(text)))
        assert got[i]["near_next"] == slow_likeness(text, following) < 0.5
        assert got[i]["near_edited"] == slow_likeness(text, other)
        assert len(text) < 24 or 0 < got[i]["near_edited"] < 1


def test_long_texts_like_all_their_anchors(make):
    rng = np.random.default_rng(6)
    shared = words(rng, 100, 4000)
    texts = [words(rng, n, 4000) for n in (2500, 1200, 1250, 30)]
    texts[1] = texts[1][:3000] + shared + texts[1][3000:]  # a passage of two long texts
    texts[2] = texts[2][:3000] + shared + texts[2][3000:]
    got = {r["doc_id"]: r for r in run(make, list(enumerate(texts)))}
    for i, text in enumerate(texts):
        following = texts[i - 1]
        half = len(text) // 2
        other = text[:len(text) - half] + following[:half]
        places = [int(x.split(":")[1], 16) for x in got[i]["fingerprint"].split(",")]
        assert sorted(places) == sorted(slow_sets(text).values())
        assert got[i]["near_next"] == pytest.approx(slow_likeness(text, following), abs=1e-9)
        assert got[i]["near_edited"] == pytest.approx(slow_likeness(text, other), abs=1e-9)
    assert got[2]["near_next"] > 0.01

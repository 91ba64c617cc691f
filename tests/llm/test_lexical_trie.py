import math
import re
from collections import Counter

import numpy as np
import pytest

from fieldnotes.llm import lexical_trie
from tests.llm.conftest import words

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOW))


def brute(docs, items, k):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for i, own in asked.items():
        found = []
        for d, c in counts:
            m = 100 - 90 + (90 * c.total() * n_docs) // n_terms if n_terms else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in own if c[t])
            if score > 0:
                found.append((-score, d is None, d or 0))
        out += [(i, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def searched(spark, docs, items, k=10):
    table = spark.createDataFrame(items, "item_id bigint, text string, rank int, doc_id string, term string")
    return sorted(map(tuple, lexical_trie.search(docs, table, k).collect()), key=repr)


def items_of(rows, n, rng):
    texts = [t for _, t in rows if t]
    return [(i, " ".join(texts[int(rng.integers(len(texts)))].split()[:int(rng.integers(1, 30))]).title(), 1, "x", "t") for i in range(n)]


@pytest.mark.parametrize("leaf,trie,vocabulary", [(32, 8192, 1_000_000), (2, 16, 40)])
def test_like_brute_force(make, spark, monkeypatch, leaf, trie, vocabulary):
    """Small leaves, several tries a task and several blocks of items too."""
    for name, value in (("LEAF", leaf), ("TRIE", trie), ("VOCABULARY", vocabulary)):
        monkeypatch.setattr(lexical_trie, name, value)
    rng = np.random.default_rng(leaf)
    rows = [(i, words(rng, int(rng.integers(1, 120)), 30)) for i in range(150)]
    rows += [(200 + i, rows[i % 3][1]) for i in range(40)] + [(400, None), (401, ""), (402, "?! .."), (403, "É café 12 A1b")]
    rows += [(None, rows[0][1]), (5, rows[7][1]), (5, rows[7][1])]
    items = items_of(rows, 12, rng) + [(50, None, 1, "x", "t"), (51, "nowhere", 1, "x", "t"), (52, "É CAFÉ a1B", 1, "x", "t"),
                                       (3, rows[9][1], 1, "x", "t"), (None, rows[8][1], 1, "x", "t")]
    assert searched(spark, make(rows), items) == brute(rows, [i[:2] for i in items], 10)


def test_a_hot_text_long_texts_and_empty_tables(make, spark):
    rng = np.random.default_rng(5)
    long = words(rng, 50_000, 300)
    rows = [(i, "kalo kalo mi") for i in range(60)] + [(100 + i, words(rng, 20, 300)) for i in range(60)] + [(500, long), (501, long)]
    items = [(1, "kalo mi", 1, "x", "t"), (2, long[:200], 1, "x", "t")]
    assert searched(spark, make(rows), items, 15) == brute(rows, [i[:2] for i in items], 15)
    assert searched(spark, make([]), items) == []
    assert searched(spark, make(rows[:3]), []) == []


def test_terms_are_the_regular_expression_s():
    rng = np.random.default_rng(1)
    odd = [chr(c) for c in (*range(0, 300), 0x2028, 0x3000, 0x1F642)]
    for _ in range(300):
        text = "".join(rng.choice(odd, 40))
        assert [t.decode() for t in lexical_trie.terms(text.encode())] == terms(text)


def test_bounds_hold_and_cut():
    """A node's part of a score is at least that of each document below."""
    rng = np.random.default_rng(2)
    size = 50
    vectors = [(i, int(rng.integers(10, 200)), (t := rng.permutation(size)[:int(rng.integers(1, 20))]).astype(np.uint32),
                rng.integers(1, 9, len(t)).astype(np.uint32)) for i in range(300)]
    w = rng.integers(1, 5000, size)
    trie = lexical_trie.Trie(vectors, rng.permutation(size), w)
    stack, leaves = [trie.root], []
    while stack:
        node = stack.pop()
        stack += node.children
        leaves += [] if node.children else [node]
        bound = dict(zip(node.term.tolist(), node.part.tolist()))
        for d in range(node.low, node.high):
            at = slice(trie.at[d], trie.at[d + 1])
            assert all(bound[t] >= p for t, p in zip(trie.term[at].tolist(), trie.part[at].tolist()))
    assert sorted(d for x in leaves for d in range(x.low, x.high)) == list(range(300))
    assert max(x.high - x.low for x in leaves) <= lexical_trie.LEAF

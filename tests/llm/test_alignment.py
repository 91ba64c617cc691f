import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fieldnotes.llm import alignment
from fieldnotes.llm.queries import BYTE_TOKENIZER, PIECE_TOKENIZER, tokenizer_path
from tests.llm.conftest import words

A, B = tokenizer_path(BYTE_TOKENIZER), tokenizer_path(PIECE_TOKENIZER)
TEXTS = ["Hello there, Straße 12!", "a  b   c ", "  lead", "tabs\tand\n\nlines", "x<|endoftext|>y <s> </s> <0x41>", "日本語 🙂 ok",
         "▁ stands for a space", "naïveté déjà-vu", "aaaaaaaaaaaaaaaaaaaa", "the the the", " ", "é", "nul \x00 byte", "don't won't I'm"]


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def encoded(library, text):
    """(id, bytes) of A's and B's tokens, from the libraries alone."""
    a, b = library
    signs = alignment.byte_signs()
    by_a = [(e, bytes(signs[c] for c in a.id_to_token(e))) for e in a.encode(" " + text, add_special_tokens=False).ids]
    by_b = []
    for e in b.encode(text):
        p = b.id_to_piece(e)
        by_b.append((e, bytes.fromhex(p[3:5]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()))
    return by_a, by_b


def spans(tokens):
    at, out = 0, []
    for e, data in tokens:
        out.append((e, at, at + len(data)))
        at += len(data)
    return out


def brute(library, rows):
    found, counts = [], Counter()
    for d, text in rows:
        by_a, by_b = encoded(library, text) if text else ([], [])
        want = (" " + (text or "")).encode()
        if not text or any(b"".join(x for _, x in t) != want for t in (by_a, by_b)):
            found.append((d, 0, 0, [], []))
            continue
        a, b = spans(by_a), spans(by_b)
        pairs = [(x, y) for x, s, e in a for y, f, g in b if s < g and f < e]
        counts.update(pairs)
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [(",".join(str(x) for x, _, e in a if lo < e <= hi), ",".join(str(y) for y, _, e in b if lo < e <= hi))
                  for lo, hi in zip([0, *cuts], cuts)]
        found.append((d, len(a), len(b), groups, pairs))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return sorted(((d, na, nb, len(g), len(p), sum(counts[q] == best[q[1]] for q in p), sum(counts[q] for q in p),
                    hashlib.sha256(";".join(f"{x}|{y}" for x, y in g).encode()).hexdigest() if g else "")
                   for d, na, nb, g, p in found), key=repr)


def aligned(docs):
    return sorted(map(tuple, alignment.align(docs, A, B).collect()), key=repr)


def corpus():
    rng = np.random.default_rng(4)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100, None), (101, ""), (None, "null key"), (0, "again the the")]
    return rows + [(200 + i, words(rng, int(rng.integers(1, 60)))) for i in range(30)] + [(300 + i, "the same words") for i in range(30)]


def test_like_brute_force(make, library):
    rows = corpus()
    got = aligned(make(rows))
    assert got == brute(library, rows)
    assert {r[0]: r[1] for r in got}[6] == 0  # the sign for a space is not a space


def test_blocks_of_pairs_and_full_tasks(make, library, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", 40)
    monkeypatch.setattr(alignment, "HELD", 10)
    rows = corpus()
    assert aligned(make(rows)) == brute(library, rows)


def test_pairs_of_same_bytes_count_together(make, library):
    """A pair counts in the vectors and in irregular groups alike."""
    t = alignment.tokenizers_of(A, B)
    rows = [(1, "aaaa aaaaa aaaaaaa"), (2, "a aa aaa"), (3, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaa a")]
    assert aligned(make(rows)) == brute(library, rows)
    assert (t.same >= 0).sum() > 10_000
    for i in np.flatnonzero(t.same >= 0)[::97]:
        assert t.bytes_a[i] == t.bytes_b[t.same[i]]


def test_empty_table_and_a_long_text(make, library):
    assert aligned(make([])) == []
    rng = np.random.default_rng(8)
    long = words(rng, 60_000, 3000)
    ((_, n_a, n_b, _, links, best, _, digest),) = aligned(make([(1, long)]))
    a, b = encoded(library, long)
    assert (n_a, n_b) == (len(a), len(b)) and links >= best > 0 and len(digest) == 64


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from(list("aZé ß\t\n  ▁<s>日🙂01.,'")), max_size=60))
def test_pieces_are_the_library_s(text):
    t = alignment.tokenizers_of(A, B)
    if "▁" not in text and text:
        assert t.ids_b(text).tolist() == t.b.encode(text)
    if text:
        assert t.ids_a(text).tolist() == t.encode_a.tokenizer.encode(" " + text, add_special_tokens=False).ids


def test_pieces_are_learned_without_threads_for_each_call():
    class Counted:
        def __init__(self, real):
            self.real, self.threads = real, []

        def encode(self, texts, **options):
            self.threads.append(options.get("num_threads"))
            return self.real.encode(texts, **options)

    t = alignment.Tokenizers(A, B)
    want = [t.b.encode(text) for text in ("some words, Straße 12", "other words déjà-vu")]
    t.b = Counted(t.b)
    got = [t.ids_b(text).tolist() for text in ("some words, Straße 12", "other words déjà-vu")]
    assert got == want and t.b.threads == [1, 1]

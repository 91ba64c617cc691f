import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fieldnotes.llm import packing, records
from fieldnotes.llm.common import shared_path
from fieldnotes.llm.tokens import ChunkEncoder
from tests.llm.conftest import words

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
ENCODERS = {p: ChunkEncoder(p) for p in (WORD, BYTE)}
ODD = ["", " ", "\n", "  a", "a  ", "a \n b", "it's 3rd 'S", "naïve Straße İı ſ", "x<|endoftext|>y", "a\x1cb\x85c\xa0d",
       "１２ ﬁ é 中文 𝒳", "the. the, the.\nThe", "\t\r\x0b\x0c"]


@settings(max_examples=300, deadline=None)
@given(st.sampled_from(list(ENCODERS)),
       st.lists(st.one_of(st.sampled_from([*ODD, "the", " ", "\n", ".", ","]), st.text(max_size=4)), max_size=12).map("".join))
def test_chunks_encode_like_the_whole(path, text):
    e = ENCODERS[path]
    assert np.frombuffer(e.encode(text), e.dtype).tolist() == e.ids(text)


def test_a_small_cache_and_a_very_long_text():
    rng = np.random.default_rng(5)
    e = ChunkEncoder(BYTE, cache=60_000)
    for _ in range(3):
        text = words(rng, 120_000, 4000)
        assert np.frombuffer(e.encode(text), e.dtype).tolist() == e.ids(text)


def ids_of(path, text):
    return ENCODERS[path].ids(text or "") + [0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def sample(n=60):
    rng = np.random.default_rng(3)
    rows = [(i * 3, words(rng, int(rng.integers(1, 3000)))) for i in range(n)]
    return rows + [(1000 + i, t) for i, t in enumerate(ODD)] + [(2000, None), (5, "same"), (5, "same")]


def test_packing_is_whole_and_tight(make):
    rows = sample()
    got = packing.pack(make(rows), WORD).collect()
    want = sorted((k, n, at, len(ids[at:at + 2048]), crc(ids[at:at + 2048]))
                  for k, t in rows for ids in [ids_of(WORD, t)] for n, at in enumerate(range(0, len(ids), 2048)))
    assert sorted(tuple(r)[:5] for r in got) == want
    bins = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == bins.get(r["sequence_id"], 0)
        bins[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(bins.values()) <= 2048
    assert len(bins) <= -(-sum(w[3] for w in want) // 2048) + 1


def test_packing_of_nothing(make):
    assert packing.pack(make([]), WORD).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 6), min_size=1, max_size=12), st.integers(40, 64))
def test_fullest_bin_like_brute_force(histogram, capacity):
    counts = [histogram.get(n, 0) for n in range(capacity + 1)]
    seed = max(histogram)
    sums = {seed}
    for length, n in histogram.items():
        for _ in range(n - (length == seed)):
            sums |= {s + length for s in sums if s + length <= capacity}
    chosen = packing.fullest(counts, capacity, seed)
    assert sum(k * n for k, n in chosen.items()) == max(sums)
    assert all(n <= histogram[k] for k, n in chosen.items())
    used = {}
    for combination, bins in packing.patterns(histogram, capacity):
        assert sum(k * n for k, n in combination.items()) <= capacity
        for k, n in combination.items():
            used[k] = used.get(k, 0) + n * bins
    assert used == histogram


def test_records_come_back(make):
    rows = sample() + [(None, "no key")]
    got = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["start"], r["n_tokens"], r["ids_crc32"])
                  for r in records.round_trip(make(rows), BYTE).collect()), key=lambda r: r[2])
    start = 0
    want = []
    for k, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = ids_of(BYTE, t)
        want.append((k is not None, k or 0, start, len(ids), crc(ids)))
        start += len(ids)
    assert got == want


def test_records_of_nothing(make):
    assert records.round_trip(make([]), BYTE).collect() == []


def test_reading_in_any_order_and_damage(spark, make):
    rows = sample(12)[:12]
    manifest = records.write_records(make(rows), BYTE, shared_path(spark, "test-records")).orderBy("shard").collect()
    by = dict(rows)
    for shard in manifest:
        reader = records.ShardReader(shard["path"])
        for n in reversed(range(len(reader))):
            key, ids = reader[n]
            assert ids.tolist() == ids_of(BYTE, by[key])
    assert sum(m["n_docs"] for m in manifest) == 12
    whole = records.frame(b"payload")
    assert records.unframe(whole) == (b"payload", len(whole))
    for at in (0, 9, 14, len(whole) - 1):
        broken = bytearray(whole)
        broken[at] ^= 1
        with pytest.raises((ValueError, struct.error)):
            records.unframe(bytes(broken))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_special_tokens_as_the_plain_library_has_them(name):
    """No flag of the library is set on either side."""
    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    enc = ChunkEncoder(path)
    for text in ("x<|endoftext|>y", "a  <|startoftext|> b\n<|endoftext|>", "<|ENDOFTEXT|> <|endoftext|", "plain words, only"):
        want = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(enc.encode(text), enc.dtype).tolist() == want
    assert ChunkEncoder(path, plain=True).ids("<|endoftext|>") != enc.ids("<|endoftext|>")


def test_a_small_cache_changes_nothing():
    path = public_tokenizers.path("byte_bpe_50k.json")
    small, large = ChunkEncoder(path, cache=20), ChunkEncoder(path)
    rng = np.random.default_rng(6)
    for _ in range(30):
        text = words(rng, 60, 300) + " the end, " * 3
        assert small.encode(text) == large.encode(text)
        assert len(small._cache) <= 20 + 61

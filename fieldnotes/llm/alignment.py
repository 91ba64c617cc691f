"""Alignment of two tokenizers' tokens over all documents.

Each text is encoded by a byte-level tokenizer A (with a space before it) and
by a piece tokenizer B, which adds that space itself. Byte offsets where
tokens of both end cut them into groups; two tokens are linked where their
bytes overlap. Over a document's merged token ends, each stretch between two
of them is exactly one link, so links come from two sorted arrays without
loops. How often an id pair is linked is counted over all documents.

An array, made once, names for each A id the B id of the same bytes. A group
of one A token and that B token is the common case: those are counted in
vectors as long as the vocabulary, one per task. Only links of other groups
become (pair, count) rows, added up per task before they are shuffled.

1. One pass encodes the texts and writes a row per document: counts, digest,
   and its links as packed ids.
2. Counts of all pairs, from these rows.
3. The rows are read again with the pairs' counts, ``BLOCK`` pairs at a time
   (nearly always one block), broadcast as that bounds their size; sums over
   the blocks are added up.

Defined results: texts that are NULL, empty, or whose A or B tokens do not
spell space + text have no tokens: zeros and an empty digest. Special tokens'
strings are plain text. Very long texts are aligned whole. Rows that repeat a
doc_id are each returned, and each count. Ties: a link is best if its count
equals the highest of its B id. Empty tables give no rows. Other columns are
never read, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldnotes.llm.common import pa_schema, small_batches, stage, text_of
from fieldnotes.llm.tokens import encoder

BATCH = 256
BLOCK = 2_000_000  # pairs that are broadcast at once
HELD = 2_000_000  # pairs that a task adds up before it hands them on
CACHE = 400_000
ROW = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
       "plain binary, pairs binary")
RESULT = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
          "groups_sha256 string")
_RUN = re.compile(" +[^ ]*")

_loaded: dict[tuple[str, str], Tokenizers] = {}


def tokenizers_of(a: str, b: str) -> Tokenizers:
    """One pair of tokenizers, and so one cache, per worker process."""
    if (a, b) not in _loaded:
        _loaded[a, b] = Tokenizers(a, b)
    return _loaded[a, b]


def byte_signs() -> dict[str, int]:
    """The characters that byte-level tokenizers write bytes as: printable
    ones stand for themselves, the others take those from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    def __init__(self, a: str, b: str):
        import sentencepiece
        self.encode_a = encoder(a, plain=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        signs = byte_signs()
        vocabulary = self.encode_a.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * max(self.encode_a.tokenizer.get_vocab_size(), *(i + 1 for i in vocabulary.values()))
        for piece, i in vocabulary.items():
            self.bytes_a[i] = bytes(signs[c] for c in piece)
        self.bytes_b = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
                        else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.b.get_piece_size())]
        self.same = same_bytes(self.bytes_a, self.bytes_b, [self.b.is_byte(i) for i in range(len(self.bytes_b))])
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        names = [str(i).encode() for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
        self.name_length = np.array([len(x) for x in names], np.int64)
        self.name = np.array(names, f"S{len(names[-1]) + 1}").view(np.uint8).reshape(len(names), -1)
        self._exact_a = self.encode_a.tokenizer.normalizer is None
        self._space = array("I", [self.b.piece_to_id("▁")]).tobytes()
        self._cut = not any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(len(self.bytes_b)))
        self._cache: dict[str, bytes] = {"": self._space}
        self._older: dict[str, bytes] = {}
        self._odd: set[str] = set()  # chunks that their pieces do not spell

    def ids_a(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode_a.encode(" " + text), self.encode_a.dtype).astype(np.int64)

    def ids_b(self, text: str) -> np.ndarray | None:
        """Ids of a text, or None if they do not spell space + text. No piece
        holds a space behind another character, so a text can be cut before
        each run of spaces, and what follows one space is encoded once and
        then looked up."""
        spaced = " " + text
        if not self._cut:
            ids = self.b.encode(text)
            return np.array(ids, np.int64) if self._spelled(ids) == spaced.encode("utf-8", "surrogatepass") else None
        chunks = [c[1:] for c in _RUN.findall(spaced)] if "  " in spaced else spaced.split(" ")[1:]
        out = []
        for at in range(0, len(chunks), 50_000):
            part = chunks[at:at + 50_000]
            got = list(map(self._cache.get, part))
            if None in got:
                self._learn({c for c, ids in zip(part, got) if ids is None})
                got = map(self._cache.__getitem__, part)
            if self._odd and not self._odd.isdisjoint(part):
                return None
            out.append(b"".join(got))
            if len(self._cache) > CACHE:
                self._older, self._cache = self._cache, {"": self._space}
        return np.frombuffer(b"".join(out), np.uint32).astype(np.int64)

    def _spelled(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_b[i] for i in ids])

    def _learn(self, missing: set[str]) -> None:
        for chunk in missing:
            if chunk in self._older:
                self._cache[chunk] = self._older[chunk]
        new = list(missing.difference(self._older))
        # by default the library starts threads for every call, which cost more than a text's chunks
        for chunk, ids in zip(new, self.b.encode(new, num_threads=1)):
            self._cache[chunk] = array("I", ids).tobytes()
            if self._spelled(ids) != b" " + chunk.encode("utf-8", "surrogatepass"):
                self._odd.add(chunk)

    def both(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and B, if both spell space + text. Bytes that a byte-level
        tokenizer does not normalise are spelled as they are."""
        if not text:
            return None
        b = self.ids_b(text)
        if b is None:
            return None
        a = self.ids_a(text)
        if self._exact_a:
            same = self.length_a[a].sum() == self.length_b[b].sum()
        else:
            same = b"".join([self.bytes_a[i] for i in a.tolist()]) == b" " + text.encode("utf-8", "surrogatepass")
        return (a, b) if same else None

    def written(self, ids_a: np.ndarray, ids_b: np.ndarray, groups_a: np.ndarray, groups_b: np.ndarray) -> tuple[bytes, np.ndarray]:
        """All groups as text, and where each one ends in it. Names are set out
        in one array, in the order of groups and A before B, each with the sign
        that follows it, and what no name needs is masked out."""
        n_a, n_b = np.bincount(groups_a), np.bincount(groups_b)
        ends_a, ends_b = np.cumsum(n_a), np.cumsum(n_b)
        ids, sign = np.empty(len(ids_a) + len(ids_b), np.int64), np.full(len(ids_a) + len(ids_b), ord(","), np.uint8)
        place_b = np.arange(len(ids_b)) + ends_a[groups_b]
        ids[np.arange(len(ids_a)) + (ends_b - n_b)[groups_a]], ids[place_b] = ids_a, ids_b
        last = ends_a + ends_b - 1
        sign[last - n_b], sign[last] = ord("|"), ord(";")
        cells, length = self.name[ids], self.name_length[ids]
        cells[np.arange(len(ids)), length] = sign
        text = cells[np.arange(cells.shape[1]) <= length[:, None]].tobytes()
        return text, np.cumsum(length + 1)[last]


def same_bytes(a: list[bytes], b: list[bytes], single: list[bool]) -> np.ndarray:
    """For each A id the B id of the same bytes (a whole piece before a byte
    fallback), or -1."""
    ids: dict[bytes, int] = {}
    for wanted in (False, True):
        for i, data in enumerate(b):
            if single[i] == wanted and data:
                ids.setdefault(data, i)
    return np.array([ids.get(data, -1) for data in a], np.int64)


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(places in A, places in B, whether a group ends here, byte) of each
    link, in order; the tokens end at the given bytes, the last at the same."""
    ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")  # two runs: merged
    ends = ends[np.diff(ends, append=-1) != 0]
    at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
    return at_a, at_b, (ends_a[at_a] == ends) & (ends_b[at_b] == ends), ends


def _encode(docs: DataFrame, a: str, b: str) -> DataFrame:
    schema = pa_schema(ROW)

    def rows_of(t: Tokenizers, texts: list[str | None]) -> list[list]:
        got = [t.both(x) for x in texts]
        filled = [i for i, g in enumerate(got) if g]
        n_a, n_b = (np.zeros(len(texts), np.int64) for _ in range(2))
        groups, n_links = (np.zeros(len(texts), np.int64) for _ in range(2))
        digest, plain, pairs = [""] * len(texts), [b""] * len(texts), [b""] * len(texts)
        if filled:
            n_a[filled], n_b[filled] = ([len(got[i][k]) for i in filled] for k in (0, 1))
            ids_a, ids_b = (np.concatenate([got[i][k] for i in filled]) for k in (0, 1))
            ends_a, ends_b = np.cumsum(t.length_a[ids_a]), np.cumsum(t.length_b[ids_b])
            at_a, at_b, closes, ends = links(ends_a, ends_b)
            link_a, link_b = ids_a[at_a], ids_b[at_b]
            usual = closes & np.concatenate([[True], closes[:-1]]) & (t.same[link_a] == link_b)
            # a document's links and groups end where its last token does
            last = np.searchsorted(ends, ends_a[np.cumsum(n_a[filled]) - 1]) + 1
            first = np.concatenate([[0], last[:-1]])
            before = np.concatenate([[0], np.cumsum(closes)])
            groups[filled], n_links[filled] = before[last] - before[first], last - first
            cuts = ends[closes]
            text, ended = t.written(ids_a, ids_b, np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b))
            ended = np.concatenate([[0], ended])
            id_type, pair_type = _widths(len(t.same), len(t.bytes_b))
            pair = (link_a * len(t.bytes_b) + link_b).astype(pair_type)
            known = link_a.astype(id_type)
            for i, x, y in zip(filled, first.tolist(), last.tolist()):
                own = usual[x:y]
                plain[i], pairs[i] = known[x:y][own].tobytes(), pair[x:y][~own].tobytes()
                digest[i] = hashlib.sha256(text[ended[before[x]]:ended[before[y]] - 1]).hexdigest()
        return [n_a.tolist(), n_b.tolist(), groups.tolist(), n_links.tolist(), digest, plain, pairs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers_of(a, b)
        for batch in batches:
            if batch.num_rows:
                got = rows_of(t, batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(x, f.type) for x, f in zip(got, list(schema)[1:]))], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, ROW)


def _widths(n_a: int, n_b: int) -> tuple[str, str]:
    """Types of a packed A id and of a packed pair."""
    return "<u2" if n_a <= 1 << 16 else "<u4", "<u4" if n_a * n_b <= 1 << 32 else "<u8"


def _counts(rows: DataFrame, same: np.ndarray, n_b: int) -> DataFrame:
    """(pair, n) of all links; a pair is A id * size of B + B id."""
    ddl = "pair bigint, n bigint"
    schema = pa_schema(ddl)
    shared = rows.sparkSession.sparkContext.broadcast(same)
    id_type, pair_type = _widths(len(same), n_b)

    def added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        pair, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        return pair, np.bincount(at, np.concatenate([h[1] for h in held]), len(pair)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same = shared.value
        usual, held = np.zeros(len(same), np.int64), []
        out = lambda pair, n: pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int64)), pa.array(n)], schema=schema)
        for batch in batches:
            usual += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), id_type), minlength=len(same))
            held.append(np.unique(np.frombuffer(b"".join(batch.column(1).to_pylist()), pair_type).astype(np.int64),
                                  return_counts=True))
            if sum(len(h[0]) for h in held) > 2 * HELD:
                held = [added(held)]
                if len(held[0][0]) > HELD:
                    yield out(*held.pop())
        if held:
            yield out(*added(held))
        own = np.flatnonzero(usual)
        yield out(own * n_b + same[own], usual[own])

    return rows.select("plain", "pairs").mapInArrow(run, ddl).groupBy("pair").agg(F.sum("n").alias("n"))


def _looked_up(rows: DataFrame, same: np.ndarray, n_b: int, pair: np.ndarray, n: np.ndarray, best: np.ndarray) -> DataFrame:
    """The rows with n_best and count_sum of the links whose pair is one of
    the given (sorted)."""
    shared = rows.sparkSession.sparkContext.broadcast((same, pair, n, best))
    id_type, pair_type = _widths(len(same), n_b)
    ddl = f"{RESULT}, row bigint"
    schema = pa_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same, pair, n, best = shared.value

        def found(wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = np.minimum(np.searchsorted(pair, wanted), len(pair) - 1)
            hit = pair[at] == wanted
            return np.where(hit, n[at], 0), hit & best[at]

        def by_row(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
            upto = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
            return upto[edges[1:]] - upto[edges[:-1]]

        usual_n, usual_best = found(np.arange(len(same)) * n_b + same)
        for batch in batches:
            sums, bests = 0, 0
            for column, width in (("plain", id_type), ("pairs", pair_type)):
                data = batch.column(column).to_pylist()
                edges = np.cumsum([0, *(len(d) // int(width[2]) for d in data)])
                ids = np.frombuffer(b"".join(data), width).astype(np.int64)
                count, is_best = (usual_n[ids], usual_best[ids]) if column == "plain" else found(ids)
                sums, bests = sums + by_row(count, edges), bests + by_row(is_best, edges)
            if batch.num_rows:
                more = {"n_best": pa.array(bests, pa.int64()), "count_sum": pa.array(sums, pa.int64())}
                yield pa.RecordBatch.from_arrays([more[f.name] if f.name in more else batch.column(f.name) for f in schema], schema=schema)

    return rows.mapInArrow(run, ddl)


def align(docs: DataFrame, a: str, b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)
    of every row; ``a`` and ``b`` are files of a byte-level and a piece tokenizer."""
    spark = docs.sparkSession
    small_batches(spark, BATCH)
    t = tokenizers_of(a, b)
    n_b = len(t.bytes_b)
    rows = stage(_encode(docs, a, b).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = stage(_counts(rows, t.same, n_b), "pair-counts")
    highest = np.zeros(n_b, np.int64)
    top = counts.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("n").alias("n")).toArrow()
    highest[top.column(0).to_numpy()] = top.column(1).to_numpy()

    blocks = max(1, math.ceil(counts.count() / BLOCK))
    sums = None
    for block in range(blocks):
        own = counts.where(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == block).toArrow()
        pair, n = own.column(0).to_numpy(), own.column(1).to_numpy()
        order = np.argsort(pair)
        pair, n = (x[order] if len(x) else np.array([-1]) for x in (pair, n))
        found = _looked_up(rows, t.same, n_b, pair, n, n == highest[pair % n_b])
        sums = found if sums is None else sums.unionByName(found)
    if blocks > 1:
        summed = ("n_best", "count_sum")
        sums = sums.groupBy("row").agg(*(F.sum(c).alias(c) if c in summed else F.first(c).alias(c)
                                         for c in sums.columns if c != "row"))
    return sums.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

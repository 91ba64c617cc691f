"""Removal of repeated passages: every byte covered by a string of ``LENGTH``
bytes that also starts anywhere else.

Suffixes that share their first ``LENGTH`` bytes are found bucket by bucket:

1. The suffix starts of each text are dealt into buckets by content. Of the
   ``GRAM``-byte substrings of its first ``LENGTH`` bytes, a start belongs to
   the one with the smallest hash (the leftmost of equals), its anchor; equal
   strings have equal anchors at equal distance. Starts in a row with the same
   anchor are one block. Only hashes of blocks are counted over all texts.
2. Blocks whose anchor stands nowhere else are unique. Blocks that are equal
   as a whole are repeated as a whole, and go on as one.
3. Where blocks around an anchor differ, the block texts of that bucket are
   fetched and its suffixes are sorted by difference-cover sampling: positions
   of the cover (``COVER`` modulo ``PERIOD``) are ranked by their first bytes,
   the ranks are chained to longer prefixes, and any suffix is then placed by
   its first bytes and the ranks of the cover positions behind them. Blocks
   are aligned at their anchor, so suffixes that may be equal stand at the same
   distance from their cover positions. A task holds one run of buckets at a
   time. Buckets of more than ``MOST`` different blocks are not sorted in one
   task; their suffixes are counted one by one, by hash, across all tasks.
4. The texts that hold repeated starts are read again and cut.

Defined results: a NULL text counts as empty; texts shorter than ``LENGTH``
stay whole; equal texts of that length or more are removed wholly, all of
them; matches never cross texts, but may lie in the same one and overlap.
Strings are compared by 64-bit hashes in 1 and 2.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldnotes.llm.common import pa_schema, small_batches, stage, text_of

LENGTH, GRAM = 400, 160
SPREAD = LENGTH - GRAM  # an anchor stands at most so far behind a start
PERIOD, COVER = 57, (0, 1, 3, 13, 32, 36, 43, 52)  # a perfect difference set
MOST = 20_000
RUN_BYTES = 1 << 20  # a task takes about 50 bytes of memory for each
BATCH = 256
_BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_SAMPLED = np.isin(np.arange(PERIOD), COVER)
#: from each residue, how far ahead and how far back the next cover position is
_AHEAD = np.array([min((c - r) % PERIOD for c in COVER) for r in range(PERIOD)])
_BACK = np.array([min((r - c) % PERIOD for c in COVER) for r in range(PERIOD)])


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << n.bit_length()
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def _prefix_sums(data: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(mix(data.astype(np.uint64) + np.uint64(1)) * _power(len(data) + 1)[0][:len(data)], out=sums[1:])
    return sums


def _spans_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * _power(len(sums))[1][start] + (end - start).astype(np.uint64))


def blocks_of(text: bytes) -> tuple[np.ndarray, ...]:
    """(bucket, block id, anchor, first start, last start) of every block."""
    n = len(text) - LENGTH + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    data = np.frombuffer(text, np.uint8)
    sums = _prefix_sums(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * _power(len(sums))[1][:len(at)])
    # the smallest of each run of SPREAD + 1; the place in the low half makes it the leftmost
    low = (grams >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64)
    size = 1
    while size * 2 <= SPREAD + 1:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < SPREAD + 1:
        rest = SPREAD + 1 - size
        low = np.minimum(low[:-rest], low[rest:])
    chosen = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.diff(chosen, prepend=-1))
    last = np.append(first[1:], n) - 1
    anchor = chosen[first]
    bucket = grams[anchor]
    whole = _spans_hash(sums, first, last + LENGTH)
    block = mix(bucket ^ mix(whole + ((anchor - first) << 20 | (last - first)).astype(np.uint64)))
    return bucket, block, anchor, first, last


TEXTS = ("doc_id bigint, tid bigint, n_bytes bigint, whole_sha256 string, "
         "buckets array<bigint>, blocks array<bigint>, counts array<int>")


def _texts(docs: DataFrame) -> DataFrame:
    """(doc_id, tid, text): the text and its hash, by which rows are matched."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("tid"),
                       text_of().alias("text"))


def _scan(texts: DataFrame) -> DataFrame:
    schema = pa_schema(TEXTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, tid, text in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode("utf-8", "surrogatepass")
                bucket, block, *_ = blocks_of(data)
                block, where, counts = np.unique(block, return_index=True, return_counts=True)
                rows.append((key, tid, len(data), hashlib.sha256(data).hexdigest(),
                             bucket[where].view(np.int64), block.view(np.int64), counts.astype(np.int32)))
            yield _batch(rows, schema)

    return texts.mapInArrow(run, TEXTS)


def _same(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on (doc_id, tid), where NULL keys are equal too."""
    r = right.withColumnsRenamed({"doc_id": "_d", "tid": "_t"})
    on = (left["tid"] == r["_t"]) & left["doc_id"].eqNullSafe(r["_d"])
    return left.join(r, on, how).drop("_d", "_t")


BLOCKS = "bucket bigint, block bigint, before int, starts int, body binary"


def _wanted_blocks(text: str, ids: list[int]) -> Iterator[tuple[int, int, int, int, bytes]]:
    data = text.encode("utf-8", "surrogatepass")
    bucket, block, anchor, first, last = blocks_of(data)
    block, where = np.unique(block, return_index=True)
    hit = np.isin(block, np.array(ids, np.int64).view(np.uint64))
    where = where[hit]
    for name, of, i in zip(block[hit].view(np.int64).tolist(), bucket[where].view(np.int64).tolist(), where.tolist()):
        yield of, name, int(anchor[i] - first[i]), int(last[i] - first[i]) + 1, data[first[i]:last[i] + LENGTH]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _fetch(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of the wanted blocks (doc_id, tid, wanted: array of ids)."""
    schema = pa_schema(BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch([row for text, ids in zip(*(c.to_pylist() for c in batch.columns))
                          for row in _wanted_blocks(text, ids)], schema)

    return _same(texts, wanted).select("text", "wanted").mapInArrow(run, BLOCKS)


def _fetch_suffixes(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """One row per suffix of the wanted blocks: its hash within the bucket."""
    ddl = "suffix bigint, block bigint, at int"
    schema = pa_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, ids in zip(*(c.to_pylist() for c in batch.columns)):
                for of, name, before, starts, body in _wanted_blocks(text, ids):
                    at = np.arange(starts)
                    h = _spans_hash(_prefix_sums(np.frombuffer(body, np.uint8)), at, at + LENGTH)
                    h = mix(h ^ np.uint64(of % (1 << 64))).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h), pa.array(np.full(starts, name)), pa.array(at.astype(np.int32))], schema=schema)

    return _same(texts, wanted).select("text", "wanted").mapInArrow(run, ddl)


def _ranks(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def repeated_starts(bodies: list[bytes], bucket: np.ndarray, before: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """For each block, which of its starts have an equal suffix (over LENGTH
    bytes) in another block of the bucket."""
    sizes = starts + LENGTH - 1
    offsets = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(bodies) + bytes(8), np.uint8)
    n = len(data) - 8
    # what is kept for each byte is narrow: a bucket can hold many bytes
    of = np.repeat(np.arange(len(bodies), dtype=np.int32), sizes)
    local = np.arange(n, dtype=np.int32) - offsets.astype(np.int32)[of]
    distance = local - before.astype(np.int32)[of]  # from the anchor
    residue = (distance % PERIOD).astype(np.uint8)

    # ranks of the cover positions by 1, 3 and 6 periods of bytes
    cover = np.flatnonzero(_SAMPLED[residue])
    left = sizes[of[cover]] - local[cover]
    cover, left = cover[left >= PERIOD], left[left >= PERIOD]
    index = np.full(n, -1, np.int32)
    index[cover] = np.arange(len(cover), dtype=np.int32)
    one = _ranks(np.lib.stride_tricks.sliding_window_view(data, PERIOD)[cover].view(f"S{PERIOD}").ravel())
    three, six = np.zeros_like(one), np.zeros_like(one)
    ok = np.flatnonzero(left >= 3 * PERIOD)
    m = len(cover) + 1
    three[ok] = _ranks((one[ok] * m + one[index[cover[ok] + PERIOD]]) * m + one[index[cover[ok] + 2 * PERIOD]])
    ok = np.flatnonzero(left >= 6 * PERIOD)
    six[ok] = _ranks(three[ok] * m + three[index[cover[ok] + 3 * PERIOD]])
    del cover, left, ok

    word = np.lib.stride_tricks.sliding_window_view(data, 8)
    at = np.flatnonzero(local < starts.astype(np.int32)[of])
    key = mix(bucket[of[at]].astype(np.uint64) << np.uint64(32) | (distance[at] + SPREAD).astype(np.uint64))
    residue = residue[at]
    del of, local, distance
    ahead = _AHEAD[residue]
    far = np.minimum(ahead + 6 * PERIOD, LENGTH - PERIOD)
    key = mix(key * np.uint64(_BASE) + six[index[at + ahead]].astype(np.uint64))
    key = mix(key * np.uint64(_BASE) + one[index[at + far - _BACK[(residue + far) % PERIOD]]].astype(np.uint64))
    del ahead, far, residue, index
    for k in (0, 8, 16, LENGTH - 24, LENGTH - 16, LENGTH - 8):
        key = mix(key * np.uint64(_BASE) + word[at + k].view("<u8").ravel())
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    found = np.zeros(len(at), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    return np.split(found, np.cumsum(starts)[:-1])


def runs_of(flags: np.ndarray) -> list[int]:
    """First and last place of every run of true flags, one after another."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]])))
    edge[1::2] -= 1
    return edge.tolist()


def _sort_buckets(blocks: DataFrame) -> DataFrame:
    """(block, spans): the repeated starts of each block, as runs."""
    ddl = "block bigint, spans array<int>"
    schema = pa_schema(ddl)

    def solve(held: list[tuple]) -> pa.RecordBatch:
        names = np.array([r[0] for r in held])
        bucket = np.cumsum(np.diff(names, prepend=names[0]) != 0)
        flags = repeated_starts([r[4] for r in held], bucket, np.array([r[2] for r in held]), np.array([r[3] for r in held]))
        return _batch([(r[1], runs_of(f)) for r, f in zip(held, flags) if f.any()], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= RUN_BYTES and row[0] != held[-1][0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield solve(held)

    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocks.repartition(n, "bucket").sortWithinPartitions("bucket", "block").mapInArrow(run, ddl)


REMOVED = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def cut(text: str, marks: list[dict]) -> tuple[bytes, int, int]:
    """(bytes kept, bytes removed, runs removed) of a text; ``marks`` are its
    blocks with repeated starts (spans NULL: all)."""
    data = text.encode("utf-8", "surrogatepass")
    _, block, _, first, last = blocks_of(data)
    spans = {m["block"] % (1 << 64): m["spans"] for m in marks}
    edges = np.zeros(len(data) + 1, np.int64)
    for i in np.flatnonzero(np.isin(block, np.array(list(spans), np.uint64))):
        own = spans[int(block[i])]
        for a, b in [(0, last[i] - first[i])] if own is None else zip(own[::2], own[1::2]):
            edges[first[i] + a] += 1
            edges[first[i] + b + LENGTH] -= 1
    gone = np.cumsum(edges[:-1]) > 0
    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
    return kept, int(gone.sum()), len(runs_of(gone)) // 2


def _cut_all(texts: DataFrame, marks: DataFrame, with_text: bool) -> DataFrame:
    schema = pa_schema(REMOVED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text, own in zip(*(c.to_pylist() for c in batch.columns)):
                kept, removed, spans = cut(text, own)
                rows.append((key, len(kept) + removed, removed, spans, hashlib.sha256(kept).hexdigest(),
                             kept if with_text else None))
            yield _batch(rows, schema)

    return _same(texts, marks).select("doc_id", "text", "marks").mapInArrow(run, REMOVED)


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """What is left of every row: n_bytes, n_removed, n_spans, kept_sha256;
    with ``with_text`` also the bytes kept."""
    small_batches(docs.sparkSession, BATCH)
    texts = _texts(docs)
    scanned = stage(_scan(texts), "texts")
    rows = scanned.select("doc_id", "tid", F.explode(F.arrays_zip("buckets", "blocks", "counts")).alias("b")).select(
        "doc_id", "tid", F.col("b.buckets").alias("bucket"), F.col("b.blocks").alias("block"), F.col("b.counts").alias("n"))
    shared = (rows.groupBy("bucket").agg(F.sum("n").alias("total"), F.min("block").alias("lo"), F.max("block").alias("hi"))
              .where("total > 1").select("bucket", (F.col("lo") != F.col("hi")).alias("mixed")))
    hit = stage(rows.join(shared, "bucket"), "shared-blocks")
    blocks = stage(hit.groupBy("bucket", "block").agg(
        F.sum("n").alias("n"), F.min(F.struct("doc_id", "tid")).alias("where"), F.max("mixed").alias("mixed")), "blocks")
    undecided = (blocks.where("mixed").groupBy("bucket")
                 .agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("members"))
                 .where("least = 1").select("bucket", "members"))
    undecided = stage(blocks.join(undecided, "bucket").select("block", "where", "n", "members"), "undecided")

    def wanted(some: DataFrame) -> DataFrame:
        return some.groupBy("where").agg(F.collect_list("block").alias("wanted")).select("where.*", "wanted")

    found = _sort_buckets(_fetch(texts, wanted(undecided.where(F.col("members") <= MOST))))
    large = undecided.where(F.col("members") > MOST)
    if not large.isEmpty():
        suffixes = stage(_fetch_suffixes(texts, wanted(large)), "suffixes")
        twice = suffixes.groupBy("suffix").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("suffix")
        found = found.union(suffixes.join(twice, "suffix").groupBy("block").agg(
            F.flatten(F.collect_list(F.array("at", "at"))).alias("spans")))
    single = blocks.where("n > 1").select("block", F.lit(None).cast("array<int>").alias("spans")).union(
        found.join(blocks.where("n = 1").select("block"), "block").select("block", "spans"))
    marks = stage(hit.select("doc_id", "tid", "block").distinct().join(single, "block")
                  .groupBy("doc_id", "tid").agg(F.collect_list(F.struct("block", "spans")).alias("marks")), "marks")
    untouched = _same(scanned, marks.select("doc_id", "tid"), "left_anti").select(
        "doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.col("whole_sha256").alias("kept_sha256"))
    if not with_text:
        return _cut_all(texts, marks, False).drop("kept").union(untouched)
    whole = _same(_same(texts, marks.select("doc_id", "tid"), "left_anti"),
                  scanned.select("doc_id", "tid", "n_bytes", "whole_sha256").distinct())
    return _cut_all(texts, marks, True).union(whole.select(
        "doc_id", "n_bytes", F.lit(0).cast("long"), F.lit(0).cast("long"), "whole_sha256", F.encode("text", "utf-8")))

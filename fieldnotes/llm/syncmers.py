"""Document fingerprints from closed syncmers.

A k-mer of characters is an anchor if the smallest of its inner s-mers (by
hash) is its first or its last. That depends on the k-mer alone, so an edit
moves no anchor outside its own k-mers. The fingerprint is all distinct
anchors of the text by hash, each with the place where it first stands:
``hash:place`` in hex, comma-joined, so it grows with the text. A text under ``SHORT``
characters may hold no anchor in the half that an edit keeps; its closed
syncmers of ``SHORT_K`` characters are anchors too. The likeness of two
fingerprints is the shared part of their union, where an anchor counts as
shared only if it moved about as far as most shared ones.

``next_document`` pairs every row with the next one in descending key order
without a global sort in one task: keys are cut into ranges at quantiles,
each range is sorted on its own, and only the two outer rows of each range
are matched up with their neighbours.

Defined results: a NULL text counts as empty; the empty text has the empty
fingerprint, alike (1) to itself only; any other text has an anchor, the whole
text where no syncmer is found (an edit of a text under 22 characters may leave
it no anchor in common); rows with equal keys are ordered by their text, descending;
NULL keys come last; a table of one row is its own next.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldnotes.llm.common import pa_schema, small_batches, text_of

K, S = 24, 8
SHORT_K, SHORT_S = 8, 4
SHORT = 2 * (2 * K - S - 1)  # from 2 * K - S - 1 characters on there is an anchor
DRIFT = 32
RANGE_ROWS = 1_000
MOST_RANGES = 16_384  # larger tables get longer ranges, which Spark sorts with spilling
BATCH = 512
OUT_CHARS = 1 << 24  # fingerprints in one batch of results, about
OUT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
       "edited_fingerprint string, near_edited double, near_next double")
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_POWER = [np.uint64(pow(_BASE, n, 1 << 64)) for n in range(K + 1)]
_NONE = np.zeros(0, np.int64), np.zeros(0, np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _windows(points: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of every n characters (n a power of two), by doubling."""
    h, size = points, 1
    while size < n:
        h = h[:-size] * _POWER[size] + h[size:]
        size *= 2
    return h


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)


def whole(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A text as its one anchor; none for the empty text."""
    h = 0
    for p in _points(text).tolist():
        h = (h * _BASE + p) & _MASK
    return np.zeros(min(1, len(text)), np.int64), _mix(np.array([h][:len(text)], np.uint64))


def anchors(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the closed syncmers of a text, in order."""
    points = _points(text)
    if len(points) < k:
        return _NONE
    small = _windows(points, s)
    order = _mix(small)
    low, size, want = order, 1, k - s + 1
    while size * 2 <= want:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < want:
        low = np.minimum(low[:len(low) - (want - size)], low[want - size:])
    ends = (low == order[:len(low)]) | (low == order[k - s:])
    places = np.flatnonzero(ends)
    h = small[places]
    for at in range(s, k, s):
        h = h * _POWER[s] + small[places + at]
    return places, _mix(h)


def all_anchors(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The anchors of a text of any length; none for the empty text only."""
    places, h = anchors(text)
    if len(text) < SHORT:
        more, h2 = anchors(text, SHORT_K, SHORT_S)
        places, h = np.concatenate([places, more]), np.concatenate([h, h2])
    return (places, h) if len(h) else whole(text)


def sketch(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct anchor hashes (32 bits), ascending, and their first places."""
    places, h = all_anchors(text)
    packed = np.sort((h & np.uint64(0xFFFFFFFF00000000)) | places.astype(np.uint64))  # a text is under 2^31 long
    values = (packed >> np.uint64(32)).astype(np.uint32)
    new = np.flatnonzero(np.diff(values, prepend=~values[:1]))
    return values[new], (packed[new] & np.uint64(0xFFFFFFFF)).astype(np.int64)


def to_string(found: tuple[np.ndarray, np.ndarray]) -> str:
    return ",".join([f"{h:08x}:{p:x}" for h, p in zip(found[0].tolist(), found[1].tolist())])


def from_string(text: str) -> tuple[np.ndarray, np.ndarray]:
    pairs = [x.split(":") for x in text.split(",")] if text else []
    return (np.array([int(h, 16) for h, _ in pairs], np.uint32),
            np.array([int(p, 16) for _, p in pairs], np.int64))


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    shared, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    moved = b[1][at_b] - a[1][at_a]
    close = np.abs(moved - np.median(moved)) <= DRIFT + 0.1 * max(a[1].max(), b[1].max())
    return float(close.sum() / (len(a[0]) + len(b[0]) - len(shared)))


def edited(text: str, following: str) -> str:
    """The last half of a text replaced by as much of another's beginning."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare(key, text: str, mine, following: str, its) -> tuple:
    other = edited(text, following)
    theirs = mine if other == text else sketch(other)
    return (key, len(text), hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest(),
            to_string(mine), to_string(theirs), likeness(mine, theirs), likeness(mine, its))


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of results, cut before their fingerprints get too large."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[3]) + len(row[4])
        if size >= OUT_CHARS:
            yield _batch(held, schema)
            held, size = [], 0
    yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def ranges(docs: DataFrame, rows: int = RANGE_ROWS) -> tuple[np.ndarray, int]:
    """Key quantiles that cut the rows into ranges of about ``rows``, at most
    ``MOST_RANGES``, and the number of rows. Only keys are read."""
    got = docs.agg(F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("keys")).first()
    parts = min(MOST_RANGES, max(1, -(-got["n"] // rows)))
    if parts == 1 or not got["keys"]:
        return np.zeros(0, np.int64), got["n"]
    at = [i / parts for i in range(1, parts)]
    cuts = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), at, max(10_000, 20 * parts)).alias("q")).first()["q"]
    return np.unique(np.array(cuts, np.int64)), got["n"]


def fingerprints(docs: DataFrame, rows: int = RANGE_ROWS) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness."""
    spark = docs.sparkSession
    small_batches(spark, BATCH)
    cuts, _ = ranges(docs, rows)
    last = len(cuts) + 1

    @F.pandas_udf("int")
    def cut_of(key):
        import pandas as pd
        return pd.Series((len(cuts) - np.searchsorted(cuts, key.to_numpy(), side="left")).astype(np.int32))

    key = F.col("doc_id")
    range_of = F.when(key.isNull(), F.lit(last)).otherwise(cut_of(F.coalesce(key, F.lit(0).cast("long"))))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    ranged = base.withColumn("range", range_of)
    schema = pa_schema(OUT)

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compared() -> Iterator[tuple]:
            before = None
            for batch in batches:
                for key, text, of in zip(*(c.to_pylist() for c in batch.columns)):
                    now = (key, text, sketch(text), of)
                    if before is not None and before[3] == of:
                        yield compare(*before[:3], now[1], now[2])
                    before = now
        yield from _batches(compared(), schema)

    n = max(1, min(last + 1, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    order = [F.col("doc_id").desc_nulls_last(), F.col("text").desc()]
    within = (ranged.repartition(n, "range").sortWithinPartitions("range", *order)
              .select("doc_id", "text", "range").mapInArrow(inner, OUT))

    # the first and last rows of each range: two a range
    ends = (base.select("doc_id").withColumn("range", range_of).groupBy("range")
            .agg(F.max("doc_id").alias("high"), F.min("doc_id").alias("low")))
    keys = ends.select("range", F.explode(F.array("high", "low")).alias("key")).distinct()
    outer = (base.join(F.broadcast(keys), F.col("doc_id").eqNullSafe(F.col("key")))
             .groupBy("range").agg(F.max(F.struct("doc_id", "text")).alias("first"),
                                   F.min(F.struct("doc_id", "text")).alias("last")))
    along = Window.orderBy("range")  # one row per range
    whole = Window.partitionBy()
    outer = outer.select(
        "last", F.coalesce(F.lead("first").over(along),
                           F.min_by("first", "range").over(whole)).alias("next"))

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((compare(k, t, sketch(t), u, sketch(u)) for batch in batches
                             for k, t, u in zip(*(c.to_pylist() for c in batch.columns))), schema)

    return within.unionByName(
        outer.select("last.doc_id", "last.text", F.col("next.text").alias("following")).mapInArrow(edges, OUT))

"""MinHash near-duplicates by a multi-index Hamming join.

1. Each text becomes the set of its word shingles (64-bit hashes), its number
   of shingles, a 128-bit hash of the whole set, and a MinHash signature, of
   which 64 bytes are written. Texts with equal sets are one node from here on,
   however many copies there are.
2. ``SYMBOLS`` signature symbols of 16 bits are split into ``CHUNKS`` chunks.
   By the pigeonhole principle, two signatures that differ in fewer than
   2 * CHUNKS symbols have a chunk with at most one error, so they share a key
   when every chunk is entered once for each symbol left out. A pair at the
   asked similarity fails this with a probability of about 1e-6 or less.
3. Nodes that share a key are candidates (``links.py``): pairs whose sizes allow
   it and whose long signatures (``LONG`` symbols of 8 bits) are near enough are
   confirmed on the full sets, unless links have joined them already. Full
   sets and long signatures are made from the texts again, for nodes that share
   a key. Only links that join components leave a task, never the pairs.
4. Components of all confirmed links; each is named by its smallest doc_id.

Every link is either confirmed, or inside a component already.

Defined results: NULL, empty and white texts have the empty set, which links
with nothing: such a document is its own component, and kept. Very long
texts are taken whole. Rows with equal doc_id are each returned, whether their
texts are equal or not; NULL doc_ids count as larger than all others. Ties:
of equal sets and of a component, the smallest doc_id names it. An empty table
gives no rows. Other columns are never read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldnotes.llm.common import pa_schema, small_batches, small_side, stage, text_of, unstage
from fieldnotes.llm.components import components
from fieldnotes.llm.links import links, signatures_near

SYMBOLS, CHUNKS, LONG = 32, 8, 256
WIDTH = SYMBOLS // CHUNKS
BATCH = 512
FEATURES = "doc_id bigint, loc binary, n_shingles bigint, hash bigint, check bigint, symbols binary"
_BASE = 0x9E3779B97F4A7C15
_LOW = np.arange(256, dtype=np.uint8)
_LOW[ord("A"):ord("Z") + 1] += 32
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_rng = np.random.default_rng(20240229)
_A = _rng.integers(1, 1 << 32, LONG, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, LONG, dtype=np.uint32)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        size = 1 << n.bit_length()
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def word_hashes(text: str) -> np.ndarray:
    """One 64-bit hash per word (ASCII letters in lower case), in order."""
    data = _LOW[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    if not len(data):
        return np.zeros(0, np.uint64)
    edge = np.flatnonzero(np.diff(np.concatenate([[True], _WHITE[data], [True]])))
    start, end = edge[::2], edge[1::2]
    up, down = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def shingles(text: str, size: int) -> np.ndarray:
    """The distinct shingles of a text, sorted. With fewer words than
    ``size``, the whole sequence is the only one."""
    words = word_hashes(text)
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h = mix(h * np.uint64(0x9FB21C651E98DF25) + words[k:k + n])
    return np.unique(h)


def signature(s: np.ndarray, symbols: int = LONG) -> np.ndarray:
    """The first ``symbols`` MinHash values of a set that isn't empty."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    low = np.full(symbols, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        low = np.minimum(low, (x[at:at + 1024, None] * _A[:symbols] + _B[:symbols]).min(0))
    return low


def chunk_keys(values: np.ndarray) -> np.ndarray:
    """Keys of signatures (a row each): each chunk, with each one of its
    symbols left out."""
    symbols = (values[:, :SYMBOLS] & np.uint32(0xFFFF)).astype(np.uint64).reshape(-1, CHUNKS, WIDTH)
    out = np.empty((len(values), CHUNKS, WIDTH), np.uint64)
    for gone in range(WIDTH):
        h = np.broadcast_to(np.arange(CHUNKS, dtype=np.uint64) * np.uint64(WIDTH) + np.uint64(gone + 1),
                            symbols.shape[:2])
        for k in range(WIDTH):
            if k != gone:
                h = mix(h * np.uint64(0x9FB21C651E98DF25) + symbols[:, :, k])
        out[:, :, gone] = h
    return out.reshape(len(values), -1)


def set_hash(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    sums = [int(mix(s ^ np.uint64(salt)).sum(dtype=np.uint64)) for salt in (len(s), _BASE)]
    out = [(x * _BASE + len(s)) % (1 << 64) for x in sums]
    return tuple(x - (1 << 64) if x >> 63 else x for x in out)


def located(docs: DataFrame) -> DataFrame:
    """(doc_id, loc, text): ``loc`` is an MD5 of doc_id and text, so it finds
    the rows of a text again, also where a doc_id is NULL or repeats."""
    row = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(" "), F.col("text"))
    return row.select("doc_id", F.unhex(F.md5(named)).alias("loc"), "text")


def features(docs: DataFrame, size: int) -> DataFrame:
    small_batches(docs.sparkSession, BATCH)
    schema = pa_schema(FEATURES)
    none = np.zeros(SYMBOLS, np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sets = [shingles(t, size) for t in batch.column("text").to_pylist()]
            sigs = [signature(s, SYMBOLS) if len(s) else none for s in sets]
            hashes = [set_hash(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("loc"), pa.array([len(s) for s in sets], pa.int64()),
                 *(pa.array([h[k] for h in hashes], pa.int64()) for k in (0, 1)),
                 pa.array([s.astype(np.uint16).tobytes() for s in sigs], pa.binary())], schema=schema)

    return located(docs).mapInArrow(run, FEATURES)


def _entries(nodes: DataFrame) -> DataFrame:
    """(node, key), distinct."""
    ddl = "node bigint, key bigint"
    schema = pa_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            symbols = np.frombuffer(b"".join(batch.column("symbols").to_pylist()), np.uint16)
            keys = np.sort(chunk_keys(symbols.reshape(-1, SYMBOLS).astype(np.uint32)).view(np.int64), axis=1)
            new = np.ones(keys.shape, bool)
            new[:, 1:] = keys[:, 1:] != keys[:, :-1]
            node = np.repeat(batch.column("node").to_numpy(), keys.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[new.ravel()]), pa.array(keys[new])], schema=schema)

    return nodes.select("node", "symbols").mapInArrow(run, ddl)


def _full_sets(docs: DataFrame, wanted: DataFrame, repeats: bool, size: int) -> DataFrame:
    """(node, n, need, sketch, full) of each wanted (node, loc). ``repeats``:
    rows repeat a doc_id together with its text."""
    ddl = "node bigint, n bigint, need int, sketch binary, full binary"
    schema = pa_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, size) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([0] * len(sets), pa.int32()),
                 pa.array([signature(s).astype(np.uint8).tobytes() for s in sets], pa.binary()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], schema=schema)

    found = located(docs).join(small_side(stage(wanted, "wanted")), "loc").select("node", "text")
    return (found.dropDuplicates(["node"]) if repeats else found).mapInArrow(run, ddl)


def most_errors(similarity: float) -> int:
    """Long signatures of a pair at the similarity differ in more symbols than
    this with a probability of about 1e-7 (5.2 standard deviations)."""
    p = (1 - similarity) * 255 / 256
    return int(np.ceil(LONG * p + 5.2 * np.sqrt(LONG * p * (1 - p))))


def near_duplicates(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; texts are linked
    when den * |intersection| >= num * |union| of their shingle sets."""
    rows = stage(features(docs, size), "features")
    nodes = stage(rows.where("n_shingles > 0").groupBy("hash", "check").agg(
        F.min("doc_id").alias("rep"), F.min("loc").alias("loc"), F.first("symbols").alias("symbols"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    repeats = not rows.where("n_shingles > 0").groupBy("loc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()

    def sets_of(wanted: DataFrame) -> DataFrame:
        return _full_sets(docs, nodes.select("node", "loc").join(wanted, "node", "left_semi"), repeats, size)

    near = signatures_near(most_errors(num / den), LONG)
    whole = components(links(_entries(nodes), sets_of, near, num, den))
    named = (nodes.select("node", "hash", "check", "rep").join(whole, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    names = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = stage(named.join(names, "component").select("hash", "check", "component_id"), "components")
    unstage(nodes)
    got = rows.select("doc_id", "n_shingles", "hash", "check").join(named, ["hash", "check"], "left")
    mine = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return got.select("doc_id", "n_shingles", mine.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs``, unchanged, of which one stays for each group of
    near duplicates: the one with the smallest doc_id. Where rows repeat that
    doc_id, one stays for each different text."""
    each = stage(near_duplicates(docs, size, num, den).groupBy(F.col("doc_id").alias("_id"))
                 .agg(F.count_if("kept").alias("_n")).where("_n != 1"), "not-once")
    key = docs["doc_id"].cast("long")
    # most rows stay: ids of the others are fewer, and texts need not be shuffled to them
    gone = small_side(each.where("_n = 0").select("_id"))
    rows = docs.join(gone, key.eqNullSafe(gone["_id"]), "left_anti")
    again = each.where("_n > 1 AND _id IS NOT NULL").select("_id")
    if again.isEmpty():
        return rows
    again = small_side(again)
    return rows.join(again, key == again["_id"], "left_anti").unionByName(
        rows.join(again, key == again["_id"], "left_semi").dropDuplicates(["doc_id", "text"]))

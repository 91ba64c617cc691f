"""N-gram Jaccard join by adaptive multi-match prefixes.

All tokens (word shingles, as 64-bit hashes) have one global order, rarest
first. If x shares at least t tokens with some other set, the first l of the
tokens they share lie among the first n - t + l of its n tokens: its prefix
with l matches. A longer prefix costs more index entries, but asks for more
shared tokens before a pair is verified; each document picks its own l.

1. Equal texts (by MD5) are one node; only one copy of each goes on.
2. Counting. A task sorts the tokens of up to ``UNIT`` shingles of documents
   (a unit) and asks about them by hash range; a token that stands often in
   the unit is asked about once, with its count. Each range adds its counts up
   and answers the units with the tokens that more than one node holds.
3. Choosing. A token that no other node holds can't be shared, and stands
   first in the order. So a document left with fewer than t = ceil(num * n /
   den) tokens links with nothing. Others take the l with the least estimated
   cost: the entries read for its prefix, and the candidates (at most entries
   / l) times what their verification costs.
4. Nodes whose prefixes share a token are candidates (``links.py``); a pair
   must share min(l of x, l of y) prefix tokens before its full sets are
   compared. Links are joined to components, each named by its smallest doc_id.

Defined results: NULL, empty and white texts have the empty set and link with
nothing: their component is their own doc_id. A text with fewer words than
``size`` is one shingle; very long texts are taken whole (a document longer
than a unit is a unit of its own). Rows that repeat a doc_id are each
returned, whether their texts are equal or not. NULL doc_ids count as larger
than all others. Ties: tokens of one count are ordered by their hash, equal
costs take the smaller l. An empty table gives no rows. Other columns of the
input are never read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldnotes.llm.common import pa_schema, small_batches, stage, text_of, unstage
from fieldnotes.llm.components import components
from fieldnotes.llm.links import links, prefixes_near
from fieldnotes.llm.minhash_join import shingles

BATCH = 512
UNIT, UNIT_DOCS = 4_000_000, 60_000  # shingles and documents of a unit
PART = 2_000_000  # shingles of a hash range, about
HEAVY = 16  # times in a unit from which a token is asked about once
BYTES_PER_SHINGLE = 6
BROADCAST_ROWS = 500_000  # most copies that are left out by a broadcast
VERIFY = 1 / 64  # cost of comparing a shingle of a candidate, in index entries
NAMES, HELD, ASKED, COUNTED = range(4)
MESSAGE = "unit bigint, part int, kind int, token binary, place binary, count binary"
PREFIX = "hash binary, n bigint, need int, sketch binary, full binary"


def _planes(x: np.ndarray) -> bytes:
    """Integers as planes of one byte each, which compress better."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def _unplaned(data: bytes, dtype: type) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(dtype).ravel()


def _packed(sorted_tokens: np.ndarray) -> bytes:
    return _planes(np.diff(sorted_tokens, prepend=np.uint64(0)))


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(_unplaned(data, np.uint64), dtype=np.uint64)


def _messages(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def _ask(size: int, parts: int):
    """Units of documents (hash, text) as messages to the hash ranges."""
    schema = pa_schema(MESSAGE)

    def asked(unit: int, hashes: list[bytes], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        home = unit % parts
        counts = np.array([len(s) for s in sets], np.uint32)
        yield _messages([(unit, home, NAMES, b"".join(hashes), None, counts.tobytes())], schema)
        token = np.concatenate(sets)
        if not len(token):
            return
        place = np.repeat(np.arange(len(sets), dtype=np.uint16), counts)
        order = np.argsort(token, kind="stable")
        token, place = token[order], place[order]
        start = np.flatnonzero(np.diff(token, prepend=token[0] ^ np.uint64(1)))
        times = np.diff(np.append(start, len(token)))
        heavy = np.repeat(times >= HEAVY, times)
        if heavy.any():
            yield _messages([(unit, home, HELD, _packed(token[heavy]), _planes(place[heavy]), None)], schema)
        few, at = token[~heavy], place[~heavy]
        much, sums = token[start[times >= HEAVY]], times[times >= HEAVY].astype(np.uint32)
        edges = np.array([-(-(k << 64) // parts) for k in range(1, parts)], np.uint64)
        low, high = np.searchsorted(few, edges), np.searchsorted(much, edges)
        rows = []
        for part, (a, b) in enumerate(zip(np.split(np.arange(len(few)), low), np.split(np.arange(len(much)), high))):
            if len(a):
                rows.append((unit, part, ASKED, _packed(few[a]), _planes(at[a]), None))
            if len(b):
                rows.append((unit, part, COUNTED, _packed(much[b]), None, sums[b].tobytes()))
            if len(rows) >= 64:
                yield _messages(rows, schema)
                rows = []
        if rows:
            yield _messages(rows, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, hashes, sets, total = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                s = shingles(text, size)
                if hashes and (total + len(s) > UNIT or len(hashes) >= UNIT_DOCS):
                    yield from asked(unit, hashes, sets)
                    unit, hashes, sets, total = unit + 1, [], [], 0
                hashes.append(h)
                sets.append(s)
                total += len(s)
        if hashes:
            yield from asked(unit, hashes, sets)

    return run


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """The rows of each key in turn; rows come sorted by it."""
    held, at = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if row[key] != at and held:
                yield held
                held = []
            at = row[key]
            held.append(row)
    if held:
        yield held


def _answer():
    """Messages of a hash range, answered with the tokens of two and more."""
    schema = pa_schema(MESSAGE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches, "part"):
            for r in rows:
                if r["kind"] in (NAMES, HELD):
                    yield _messages([tuple(r.values())], schema)
            asks = [r for r in rows if r["kind"] in (ASKED, COUNTED)]
            if not asks:
                continue
            tokens = [_unpacked(r["token"]) for r in asks]
            token = np.concatenate(tokens)
            times = np.concatenate([np.ones(len(t), np.int64) if r["kind"] == ASKED
                                    else np.frombuffer(r["count"], np.uint32).astype(np.int64) for r, t in zip(asks, tokens)])
            order = np.argsort(token, kind="stable")
            token = token[order]
            start = np.flatnonzero(np.diff(token, prepend=token[0] ^ np.uint64(1)))
            sums = np.add.reduceat(times[order], start)
            df = np.empty(len(token), np.uint32)
            df[order] = np.repeat(np.minimum(sums, 0xFFFFFFFF), np.diff(np.append(start, len(token))))
            at = 0
            for r, t in zip(asks, tokens):
                mine = df[at:at + len(t)]
                at += len(t)
                shared = mine > 1
                if not shared.any():
                    continue
                place = _planes(_unplaned(r["place"], np.uint16)[shared]) if r["kind"] == ASKED else None
                yield _messages([(r["unit"], r["part"], r["kind"], _packed(t[shared]), place, _planes(mine[shared]))], schema)

    return run


def matches(df: np.ndarray, n: int, least: int) -> int:
    """How many prefix tokens a document of ``n`` shingles asks for. ``df``:
    counts of the tokens that other documents hold too, in order; ``least``
    of them at least are shared with any partner."""
    wanted = np.arange(1, least + 1)
    entries = np.cumsum(df, dtype=np.float64)[len(df) - least + wanted - 1]
    return int(np.argmin(entries * (1 + n * VERIFY / wanted))) + 1


def _choose(num: int, den: int):
    """The answers of a unit as prefixes and remaining tokens by document."""
    schema = pa_schema(PREFIX)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches, "unit"):
            by = {k: [r for r in rows if r["kind"] == k] for k in range(4)}
            (names,) = by[NAMES]
            n = np.frombuffer(names["count"], np.uint32).astype(np.int64)
            hashes = [names["token"][i:i + 16] for i in range(0, 16 * len(n), 16)]
            token = [_unpacked(r["token"]) for r in by[ASKED]]
            place = [_unplaned(r["place"], np.uint16) for r in by[ASKED]]
            df = [_unplaned(r["count"], np.uint32) for r in by[ASKED]]
            if by[HELD]:
                known = np.concatenate([_unpacked(r["token"]) for r in by[COUNTED]])
                sums = np.concatenate([_unplaned(r["count"], np.uint32) for r in by[COUNTED]])
                order = np.argsort(known)
                own = _unpacked(by[HELD][0]["token"])
                token.append(own)
                place.append(_unplaned(by[HELD][0]["place"], np.uint16))
                df.append(sums[order][np.searchsorted(known[order], own)])
            out = {i: (hashes[i], int(n[i]), 0, None, None) for i in range(len(n))}
            if token:
                token, place, df = np.concatenate(token), np.concatenate(place), np.concatenate(df)
                least = -(-num * n // den)
                left = np.bincount(place, minlength=len(n))
                keep = ((left >= least) & (n > 0))[place]
                token, place, df = token[keep], place[keep], df[keep]
                order = np.lexsort((token, df, place))
                token, place, df = token[order], place[order], df[order]
                edge = np.flatnonzero(np.diff(place.astype(np.int32), prepend=-1))
                for a, b in zip(edge, np.append(edge[1:], len(token))):
                    i = int(place[a])
                    need = matches(df[a:b], int(n[i]), int(least[i]))
                    prefix = token[a:b][:b - a - int(least[i]) + need]
                    out[i] = (hashes[i], int(n[i]), need, np.sort(prefix).tobytes(), np.sort(token[a:b]).tobytes())
            done = list(out.values())
            for k in range(0, len(done), 1024):
                yield _messages(done[k:k + 1024], schema)

    return run


def _entries(lists: DataFrame) -> DataFrame:
    """(node, key) of the prefixes."""
    ddl = "node bigint, key bigint"
    schema = pa_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                prefix = [np.frombuffer(s, np.int64) for s in batch.column(1).to_pylist()]
                node = np.repeat(np.array(batch.column(0).to_pylist(), np.int64), [len(p) for p in prefix])
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(np.concatenate(prefix))], schema=schema)

    return lists.select("node", "sketch").mapInArrow(run, ddl)


def prefixes(docs: DataFrame, parts: int, size: int, num: int, den: int) -> DataFrame:
    """(hash, n, need, sketch, full) of each row of ``docs`` (hash, text): the
    number of shingles and, for texts that may link, the matches asked for, the
    prefix and all tokens that other rows hold too. Else ``need`` is 0."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    answered = (docs.mapInArrow(_ask(size, parts), MESSAGE)
                .repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_answer(), MESSAGE))
    return answered.repartition(n, "unit").sortWithinPartitions("unit").mapInArrow(_choose(num, den), PREFIX)


def similar_classes(docs: DataFrame, size: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; texts are linked when
    den * |intersection| >= num * |union| of their shingle sets."""
    spark = docs.sparkSession
    small_batches(spark, BATCH)
    data = F.col("text").cast("binary")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn(
        "hash", F.unhex(F.md5(data)))
    rows = stage(texts.select("doc_id", "hash", F.length(data).alias("bytes")), "rows")
    nodes = stage(rows.groupBy("hash").agg(F.min("doc_id").alias("rep"), F.first("bytes").alias("bytes"))
                  .withColumn("node", F.monotonically_increasing_id()), "nodes")
    total = nodes.agg(F.sum("bytes")).first()[0] or 0
    parts = max(1, math.ceil(total / BYTES_PER_SHINGLE / PART))

    copies = stage(rows.join(nodes.select("hash", "rep"), "hash").where(~F.col("doc_id").eqNullSafe(F.col("rep")))
                   .select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash")).distinct(), "copies")
    few = copies.count() <= BROADCAST_ROWS
    once = texts.join(F.broadcast(copies) if few else copies,
                      F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")),
                      "left_anti").select("hash", "text")
    if not few:  # a unit's documents must be the same whenever a task runs again
        once = stage(once, "texts")
    found = stage(prefixes(once, parts, size, num, den), "prefixes")

    lists = stage(found.where("need > 0").dropDuplicates(["hash"]).join(nodes.select("hash", "node"), "hash")
                  .select("node", "n", "need", "sketch", "full"), "lists")
    whole = components(links(_entries(lists), lambda wanted: lists.join(wanted, "node", "left_semi"),
                             prefixes_near(), num, den))
    named = nodes.join(whole, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    sizes = found.groupBy("hash").agg(F.first("n").alias("n_shingles"))
    named = stage(named.join(least, "component").join(sizes, "hash").select("hash", "n_shingles", "component_id"), "named")
    unstage(nodes, copies, found, lists)
    mine = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.join(named, "hash").select("doc_id", "n_shingles", mine.alias("component_id"))

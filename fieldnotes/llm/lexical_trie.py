"""Ranked lexical search by a trie of documents.

Only terms that some item asks for matter: each document becomes the vector
of those terms, ordered by how many documents hold them. A task puts such
vectors into tries (frequent terms first, so that paths are shared) of up to
``TRIE`` documents. A node knows the largest tf of each term below it and the
smallest m; as a term's part of a score rises with tf and falls with m, they
bound every score below. All items go down a trie depth-first together: at a
node, an item whose bound is under its k-th best score so far leaves; children
are taken by falling bound; ``LEAF`` documents and fewer are scored exactly.
Best scores stay from one trie of a task to the next, and each task hands on
at most k rows per item.

The texts are read once per block of items (``VOCABULARY`` terms), to write
their vectors; counts over all documents come from these. Items of one block
are broadcast, as that bounds their size. Nothing but counts of an item block's
terms goes to the driver.

Scores: with N documents that hold a term at all, L terms in all, n in a
document, df documents that hold a term and tf of it in this one:
w = floor(1000 ln((2N + 2) / (2 df + 1))), m = 10 + 90 n N div L, and a
document scores the sum of w (10^9 tf div (1000 tf + 8 m)) over the item's
different terms.

Defined results: NULL and empty texts have no terms; such documents are not
counted in N and match nothing; an item without terms, or without matches,
has no rows. Very long texts are read whole. Rows that repeat a doc_id are
documents of their own, and may each take a rank. Rows that repeat an item_id
are one item with all their terms. Equal scores are ranked by doc_id, NULL
last. Empty tables give no rows. Other columns are never read, whatever
their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldnotes.llm.common import pa_schema, small_batches, stage, text_of

BATCH = 512
VOCABULARY = 1_000_000  # terms of a block of items, about
TRIE, LEAF = 8192, 32  # documents of a trie, and of a leaf
LANES = 64  # first round of joining the tasks' best rows
VECTOR = "doc_id bigint, n bigint, term binary, tf binary"
FOUND = "item int, doc_id bigint, score bigint"

#: fixed values: letters, digits and all bytes above ASCII make terms; A-Z are lowered
_TERM = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(128)) + bytes(range(128, 256))
_TABLE = _TERM.lower()
NO_DOC = np.iinfo(np.int64).max


def terms(data: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return data.translate(_TABLE).split()


def _item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms) with the different terms of each item."""
    ddl = "item_id bigint, term binary"
    schema = pa_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, t) for i, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                     for t in dict.fromkeys(terms(data))]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()),
                                              pa.array([f[1] for f in found], pa.binary())], schema=schema)

    texts = items.select(F.col("item_id").cast("long").alias("item_id"), text_of().cast("binary").alias("text"))
    return texts.mapInArrow(run, ddl).groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def _vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, term, tf): number of terms, and places in the vocabulary with
    their counts."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = pa_schema(VECTOR)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = known.value.get
        for batch in batches:
            n, term, tf = [], [], []
            for data in batch.column(1).to_pylist():
                found = terms(data)
                counts = Counter(map(place, found))
                counts.pop(None, None)
                n.append(len(found))
                term.append(np.fromiter(counts.keys(), np.uint32, len(counts)).tobytes())
                tf.append(np.fromiter(counts.values(), np.uint32, len(counts)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(term, pa.binary()),
                                              pa.array(tf, pa.binary())], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       text_of().cast("binary").alias("text")).mapInArrow(run, VECTOR)


def _document_counts(vectors: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each of ``size`` terms."""
    ddl = "term bigint, df bigint"
    schema = pa_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint32), minlength=size)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(df[held])], schema=schema)

    rows = vectors.select("term").mapInArrow(run, ddl).groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(size, np.int64)
    out[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return out


def part_of_score(w: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class Node:
    """Documents ``low`` to ``high`` of a trie's order, what bounds them, and
    their children (none: a leaf)."""

    __slots__ = ("low", "high", "term", "part", "m", "children")

    def __init__(self, low: int, high: int):
        self.low, self.high, self.children = low, high, []


class Trie:
    """``rank`` orders terms by falling document count; ``vectors`` are
    (doc, m, terms, counts), doc ``NO_DOC`` for a NULL key."""

    def __init__(self, vectors: list[tuple], rank: np.ndarray, w: np.ndarray):
        ordered = []
        for doc, m, term, tf in vectors:
            order = np.argsort(rank[term])
            ordered.append((rank[term][order].astype(">u4").tobytes(), m, doc, term[order], tf[order]))
        ordered.sort(key=lambda v: v[:3])
        self.w = w
        self.doc = np.array([v[2] for v in ordered], np.int64)
        self.m = np.array([v[1] for v in ordered], np.int64)
        self.term = np.concatenate([v[3] for v in ordered])
        self.tf = np.concatenate([v[4] for v in ordered]).astype(np.int64)
        self.at = np.cumsum([0, *(len(v[3]) for v in ordered)])
        self.part = part_of_score(w[self.term], self.tf, np.repeat(self.m, np.diff(self.at)))
        self.shared = np.array([0, *(self._common(a[3], b[3]) for a, b in zip(ordered, ordered[1:]))])
        self.root = self._grow(0, len(ordered))

    @staticmethod
    def _common(a: np.ndarray, b: np.ndarray) -> int:
        """Length of the path that two vectors share."""
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        return int(differ[0]) if len(differ) else n

    def _spans(self, low: int, high: int) -> list[tuple[int, int]]:
        """Subtrees below the path that all documents of a node share; small
        neighbours are taken together."""
        inner = self.shared[low + 1:high]
        cuts = [low, *(low + 1 + np.flatnonzero(inner == inner.min())).tolist(), high]
        spans = [(cuts[0], cuts[1])]
        for a, b in zip(cuts[1:], cuts[2:]):
            if b - spans[-1][0] <= LEAF:
                spans[-1] = (spans[-1][0], b)
            else:
                spans.append((a, b))
        return spans

    def _grow(self, low: int, high: int) -> Node:
        top, stack, made = Node(low, high), [], []
        stack.append(top)
        while stack:  # a path may be long: no recursion
            node = stack.pop()
            made.append(node)
            if node.high - node.low > LEAF:
                node.children = [Node(a, b) for a, b in self._spans(node.low, node.high)]
                stack += node.children
        maxima: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for node in reversed(made):  # children before their parent
            if node.children:
                below = [maxima.pop(id(c)) for c in node.children]
                term, tf = (np.concatenate([b[k] for b in below]) for k in (0, 1))
                node.m = min(c.m for c in node.children)
            else:
                entries = slice(self.at[node.low], self.at[node.high])
                term, tf = self.term[entries], self.tf[entries]
                node.m = int(self.m[node.low:node.high].min())
            order = np.argsort(term, kind="stable")
            term, tf = term[order], tf[order]
            start = np.flatnonzero(np.diff(term.astype(np.int64), prepend=-1))
            tf = np.maximum.reduceat(tf, start) if len(start) else tf
            node.term = term[start]
            node.part = part_of_score(self.w[node.term], tf, node.m)
            maxima[id(node)] = node.term, tf
        return top


class Best:
    """The k best (score, doc) of each item."""

    def __init__(self, items: list[np.ndarray], k: int, size: int):
        self.items, self.k = items, k
        self.score = np.zeros((len(items), k), np.int64)
        self.doc = np.full((len(items), k), NO_DOC)
        self.held = np.zeros(len(items), np.int64)
        self._part = np.zeros(size, np.int64)
        self._column = np.zeros(size, np.int64)

    def _terms_of(self, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        terms = [self.items[i] for i in alive]
        return np.concatenate(terms), np.cumsum([0, *map(len, terms[:-1])])

    def _bounds(self, node: Node, flat: np.ndarray, start: np.ndarray) -> np.ndarray:
        self._part[node.term] = node.part
        bounds = np.add.reduceat(self._part[flat], start)
        self._part[node.term] = 0
        return bounds

    def search(self, trie: Trie) -> None:
        """Depth-first, best children first, all items that a node may still serve."""
        alive = np.array([i for i, t in enumerate(self.items) if len(t)], np.int64)
        if not len(alive):
            return
        stack = [(trie.root, alive, self._bounds(trie.root, *self._terms_of(alive)))]
        while stack:
            node, alive, bounds = stack.pop()
            alive = alive[bounds >= np.maximum(self.score[alive, -1], 1)]
            if not len(alive):
                continue
            if not node.children:
                self._score(trie, node, alive)
                continue
            flat, start = self._terms_of(alive)
            below = [(child, alive, self._bounds(child, flat, start)) for child in node.children]
            stack += sorted(below, key=lambda b: b[2].max())

    def _score(self, trie: Trie, node: Node, alive: np.ndarray) -> None:
        """Exact scores of a leaf's documents."""
        entries = slice(trie.at[node.low], trie.at[node.high])
        of = np.repeat(np.arange(node.high - node.low), np.diff(trie.at[node.low:node.high + 1]))
        self._column[node.term] = np.arange(1, len(node.term) + 1)
        parts = np.zeros((len(node.term) + 1, node.high - node.low), np.int64)
        parts[self._column[trie.term[entries]], of] = trie.part[entries]
        flat, start = self._terms_of(alive)
        scores = np.add.reduceat(parts[self._column[flat]], start, axis=0)
        self._column[node.term] = 0
        docs = trie.doc[node.low:node.high]
        least, last = self.score[alive, -1, None], self.doc[alive, -1, None]
        better = (scores > least) | ((scores == least) & (scores > 0) & ((docs < last) | (self.held[alive, None] < self.k)))
        for x in np.flatnonzero(better.any(1)):
            i, new = alive[x], better[x]
            held = self.held[i]
            score = np.concatenate([self.score[i, :held], scores[x, new]])
            doc = np.concatenate([self.doc[i, :held], docs[new]])
            order = np.lexsort((doc, -score))[:self.k]
            self.held[i] = len(order)
            self.score[i, :len(order)], self.doc[i, :len(order)] = score[order], doc[order]


def _search_block(vectors: DataFrame, items: list[np.ndarray], size: int, k: int) -> DataFrame:
    """(item, doc_id, score): each task's k best of each item."""
    stats = vectors.agg(F.sum((F.col("n") > 0).cast("long")).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = stats["docs"] or 0, stats["terms"] or 0
    df = _document_counts(vectors, size)
    w = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    rank = np.empty(size, np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(size)
    shared = vectors.sparkSession.sparkContext.broadcast((items, w, rank))
    schema = pa_schema(FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, w, rank = shared.value
        best, held = Best(items, k, size), []
        for batch in batches:
            for doc, n, term, tf in zip(*(c.to_pylist() for c in batch.columns)):
                if term:
                    held.append((NO_DOC if doc is None else doc, 10 + 90 * n * n_docs // n_terms,
                                 np.frombuffer(term, np.uint32), np.frombuffer(tf, np.uint32)))
                if len(held) >= TRIE:
                    best.search(Trie(held, rank, w))
                    held = []
        if held:
            best.search(Trie(held, rank, w))
        at, place = np.nonzero(np.arange(k) < best.held[:, None])
        doc = best.doc[at, place]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(doc, mask=doc == NO_DOC),
                                          pa.array(best.score[at, place])], schema=schema)

    return vectors.mapInArrow(run, FOUND)


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item."""
    spark = docs.sparkSession
    small_batches(spark, BATCH)
    asked = stage(_item_terms(items).withColumn("terms_n", F.size("terms")), "items")
    blocks = max(1, math.ceil((asked.agg(F.sum("terms_n")).first()[0] or 0) / VOCABULARY))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    found = []
    for block in range(blocks):
        rows = asked.where(F.col("block") == block).select("item_id", "terms").collect()
        vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for r in rows for t in r["terms"]}))}
        terms_of = [np.array([vocabulary[bytes(t)] for t in r["terms"]], np.int64) for r in rows]
        vectors = stage(_vectors(docs, vocabulary), "vectors")
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], "item int, item_id bigint")
        found.append(_search_block(vectors, terms_of, len(vocabulary), k).join(F.broadcast(names), "item")
                     .select("item_id", "doc_id", "score"))
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    lanes = best.withColumn("lane", F.spark_partition_id() % LANES)
    few = lanes.withColumn("r", F.row_number().over(Window.partitionBy("item_id", "lane").orderBy(*order))).where(F.col("r") <= k)
    return (few.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
            .where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score"))

"""Links between sets that share index keys, without pairs leaving a task.

Similarity joins find candidates by keys: two sets may link only if they
share one. ``links`` turns (node, key) entries into confirmed links in three
steps, so that neither large groups of alike sets nor chains of half-alike
ones send every pair, or every set many times:

1. each node is compared with the smallest node of the key groups it stands
   in: first with the one it meets most often, then with the others that are
   not in its component yet;
2. a key group is closed when its nodes, but for that smallest one, are all
   in one component; groups of two are closed after step 1;
3. nodes of open groups make clusters, which are compared in blocks of
   ``BLOCK`` nodes or ``BLOCK_SHINGLES`` shingles. Pairs in one component are
   passed over.

A pair is compared by its sizes, then by its sketches, then on its full sets.
Every pair that shares a key is compared, or is in one component already.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldnotes.llm.common import pa_schema, small_side, stage, unstage
from fieldnotes.llm.components import components

BLOCK, BLOCK_SHINGLES = 4096, 4_000_000  # nodes, and shingles on average, of a block
SET = ("node", "n", "need", "sketch", "full")
_COLUMNS = (*SET, "label", "part", "i", "j")

#: (rows of a group as lists by column, places of the right side) -> a function
#: that keeps, of the places given to it, those whose sketch is near a place's.
Near = Callable[[dict, np.ndarray], Callable[[int, np.ndarray], np.ndarray]]


def signatures_near(errors: int, width: int) -> Near:
    """Sketches of ``width`` one-byte symbols that differ in at most ``errors``."""
    def make(cols: dict, right: np.ndarray) -> Callable[[int, np.ndarray], np.ndarray]:
        sig = np.frombuffer(b"".join(cols["sketch"]), np.uint8).reshape(-1, width)
        return lambda x, others: others[(sig[others] != sig[x]).sum(1) <= errors]
    return make


def prefixes_near() -> Near:
    """Sketches are prefixes (64-bit tokens); a pair must share as many of
    them as the smaller ``need`` of the two says."""
    def make(cols: dict, right: np.ndarray) -> Callable[[int, np.ndarray], np.ndarray]:
        prefix = [np.frombuffer(s, np.uint64) for s in cols["sketch"]]
        need = np.array(cols["need"])
        token = np.concatenate([prefix[y] for y in right])
        owner = np.repeat(right, [len(prefix[y]) for y in right])
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]

        def near(x: int, others: np.ndarray) -> np.ndarray:
            low, high = (np.searchsorted(token, prefix[x], side) for side in ("left", "right"))
            at = np.concatenate([owner[a:b] for a, b in zip(low, high) if b > a] or [owner[:0]])
            shared = np.bincount(at, minlength=len(prefix))
            return others[shared[others] >= np.minimum(need[x], need[others])]
        return near
    return make


def _compare(cols: dict, near: Near, num: int, den: int) -> list[tuple[int, int]]:
    """Links that join components, of the pairs between parts i and j."""
    node, n, part, label = (np.array(cols[c]) for c in ("node", "n", "part", "label"))
    i, j = cols["i"][0], cols["j"][0]
    left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
    if not len(left) or not len(right) or (label == label[0]).all():
        return []
    sets = [np.frombuffer(f, np.uint64) for f in cols["full"]]
    near_of = near(cols, right)
    out = []
    for x in left:
        others = right[(label[right] != label[x])
                       & (den * np.minimum(n[right], n[x]) >= num * np.maximum(n[right], n[x]))]
        if i == j:
            others = others[node[others] > node[x]]
        if len(others):
            others = near_of(x, others)
        if not len(others) or not len(sets[x]):
            continue
        words = np.concatenate([sets[y] for y in others])
        owner = np.repeat(np.arange(len(others)), [len(sets[y]) for y in others])
        at = np.minimum(np.searchsorted(sets[x], words), len(sets[x]) - 1)
        both = np.bincount(owner[sets[x][at] == words], minlength=len(others))
        for y in others[den * both >= num * (n[x] + n[others] - both)]:
            if label[y] != label[x]:
                out.append((int(node[x]), int(node[y])))
                label[label == label[y]] = label[x]
    return out


def _links_between(rows: DataFrame, near: Near, num: int, den: int) -> DataFrame:
    """Links (a, b) found in groups (cluster, i, j). A group is gathered in one
    task; its size is bounded by two blocks."""
    ddl = "a bigint, b bigint"
    schema = pa_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {c: [] for c in _COLUMNS}
        at, found = None, []

        def batch_of(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = batch.to_pydict()
            groups = list(zip(cols["cluster"], cols["i"], cols["j"]))
            first = 0
            while first < len(groups):
                to = first + 1
                while to < len(groups) and groups[to] == groups[first]:
                    to += 1
                if groups[first] != at:
                    if len(held["node"]) > 1:
                        found += _compare(held, near, num, den)
                    at, held = groups[first], {c: [] for c in _COLUMNS}
                for c in _COLUMNS:
                    held[c] += cols[c][first:to]
                first = to
            if found:
                yield batch_of(found)
                found = []
        if len(held["node"]) > 1:
            yield batch_of(_compare(held, near, num, den))

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(n, "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "node")
            .select("cluster", *_COLUMNS).mapInArrow(run, ddl))


def _star_links(pairs: DataFrame, sets: DataFrame, near: Near, num: int, den: int) -> DataFrame:
    """Links of the pairs (node, centre). A centre's nodes go to groups of a
    block at most, each with one copy of the centre's set."""
    spread = pairs.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("salts"))
    dealt = pairs.join(spread, "centre").withColumn("j", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int") + 1)
    own = dealt.select("node", F.col("centre").alias("cluster"), "j", F.col("j").alias("part"))
    centres = dealt.select(F.col("centre").alias("node"), F.col("centre").alias("cluster"), "j",
                           F.lit(0).alias("part")).distinct()
    rows = stage(own.unionByName(centres), "dealt")
    found = stage(_links_between(sets.join(small_side(rows), "node").select(
        "cluster", *SET, F.col("node").alias("label"), "part", F.lit(0).alias("i"), "j"), near, num, den), "links")
    unstage(rows)
    return found


def _labelled(rows: DataFrame, labels: DataFrame, column: str = "node") -> DataFrame:
    """``rows`` with the component of a node; one of its own where it has no link."""
    named = labels.select(F.col("node").alias("_of"), F.col("component").alias("_c"))
    return (rows.join(named, rows[column] == F.col("_of"), "left")
            .withColumn(f"{column}_label", F.coalesce("_c", column)).drop("_of", "_c"))


def _open_members(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, node, node_label) of groups that step 1 left open."""
    others = _labelled(shared.where("node != centre").select("key", "node"), labels)
    still = others.groupBy("key").agg(F.min("node_label").alias("x"), F.max("node_label").alias("y")).where("x != y")
    return others.join(still.select("key"), "key")


def _block_links(opened: DataFrame, sets: DataFrame, near: Near, num: int, den: int) -> DataFrame:
    first = opened.groupBy("key").agg(F.min("node").alias("a"))
    clusters = components(opened.join(first, "key").select("a", F.col("node").alias("b")).distinct())
    members = stage(clusters.withColumnRenamed("component", "cluster").join(
        opened.select("node", F.col("node_label").alias("label")).distinct(), "node"), "clusters")
    blocks = F.col("blocks")
    sizes = members.join(sets.select("node", "n"), "node").groupBy("cluster").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    dealt = stage(members.join(sizes, "cluster")
                  .withColumn("part", F.pmod(F.xxhash64("node"), blocks).cast("int"))
                  .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
                  .select("cluster", "node", "label", "part", F.least("part", "other").alias("i"),
                          F.greatest("part", "other").alias("j")), "dealt")
    found = stage(_links_between(sets.join(small_side(dealt), "node").select("cluster", *SET, "label", "part", "i", "j"),
                                 near, num, den), "links")
    unstage(members, dealt)
    return found


def links(entries: DataFrame, sets_of: Callable[[DataFrame], DataFrame], near: Near, num: int, den: int) -> DataFrame:
    """Links (a, b) whose components are those of all pairs that share a key
    and have den * |intersection| >= num * |union|.

    ``entries``: (node, key), distinct. ``sets_of`` gives (node, n, need,
    sketch, full) of the nodes it gets, one row each; ``n`` is a set's size,
    ``full`` its sorted 64-bit members, of which those that no other set holds
    may be left out.
    """
    groups = entries.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("centre"))
    shared = stage(entries.join(groups.where("members > 1").select("key", "centre"), "key"), "shared-keys")
    sets = stage(sets_of(shared.select("node").distinct()), "sets")
    pairs = stage(shared.where("node != centre").groupBy("node", "centre").agg(F.count(F.lit(1)).alias("keys")), "pairs")

    most = pairs.groupBy("node").agg(F.max(F.struct("keys", -F.col("centre"))).alias("m"))
    star = most.select("node", (-F.col("m")["col2"]).alias("centre"))
    first = _star_links(star, sets, near, num, den)
    labels = stage(components(first), "labels")
    rest = _labelled(_labelled(pairs.join(star, ["node", "centre"], "left_anti").select("node", "centre"), labels),
                     labels, "centre").where("node_label != centre_label").select("node", "centre")
    second = _star_links(stage(rest, "pairs"), sets, near, num, den)
    found = first.union(second)

    labels = stage(components(found), "labels")
    opened = stage(_open_members(shared, labels), "open")
    if not opened.isEmpty():
        found = found.union(_block_links(opened, sets, near, num, den))
    found = stage(found, "links")
    unstage(shared, sets, pairs, labels, opened)
    return found

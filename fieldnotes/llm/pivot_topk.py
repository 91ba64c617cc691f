"""Exact top-k inner products through a pivot-distance index.

Vectors are integers. With one more coordinate, sqrt(M - |x|^2) (M the
largest squared length; 0 for queries), all indexed vectors have the same
length, so a larger inner product is a smaller distance:
|q - x|^2 = |q|^2 + M - 2 q.x, and the triangle inequality holds.

1. ``PIVOTS`` pivots are taken far apart from a bounded sample (``SAMPLE``
   vectors, drawn by key hash). Every vector is keyed by its nearest pivot and
   the distance to it.
2. Rows are range-partitioned by (pivot, distance, id), so a pivot that holds
   a third of all rows is spread, and cut into annuli: up to ``CELL`` rows of
   one pivot with their smallest and largest distance.
3. Queries come in blocks of ``QUERIES``, neighbours together. The sample
   itself gives each query a first lower bound on its k-th best score.
4. Blocks of queries and annuli meet as summaries first (pivot, distances, the
   block's longest query and lowest bound); only pairs that the triangle
   inequality leaves open fetch their vectors, in the smallest integer type
   that holds them.
5. Each block takes its annuli in bundles. Within a bundle they are taken in the
   order of the least distance that the triangle inequality allows; a query
   skips an annulus that can't reach its k-th best score so far, and a block
   stops when none of its queries can reach the next. The best k of each bundle
   are merged per query.

Defined results: rows whose vector or id is NULL, or whose vector has a NULL
or non-finite component, take no part; shorter vectors count as followed by
zeros; ties in score go to the smaller id; a query's own id is no candidate.
Rows that repeat an id are candidates of their own, and each query row has a
ranking of its own. An empty table gives an empty result; other columns,
whatever their names, don't matter. Vectors may be of any length. Scores are
exact while squared lengths stay below 2^52 and components below 2^31 (by
Cauchy and Schwarz no partial sum is then above 2^52); larger ones raise an
error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldnotes.llm.common import key_hash60, pa_schema, small_batches, stage

PIVOTS, SAMPLE = 48, 4096
CELL, QUERIES, BUNDLE = 1024, 256, 8
LARGEST, LONGEST = 1 << 31, 1 << 52
CLEAN = "vec_id bigint, v binary, norm bigint"
KEYED = "vec_id bigint, v binary, pivot int, dist double"
CELLS = "pivot int, low double, high double, ids binary, vs binary, reach double, floor double"
FOUND = "block bigint, place int, query_id bigint, vec_id bigint, score bigint"


def quantised(rows: DataFrame, scale: float, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """floor(scale * x) of every component as int32, and the squared length."""
    schema = pa_schema(CLEAN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k, xs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k is None or xs is None or None in xs:
                    continue
                v = np.floor(scale * np.array(xs, np.float64))
                if not np.isfinite(v).all():
                    continue
                if len(v) and np.abs(v).max() >= LARGEST or (v * v).sum() >= LONGEST:
                    raise ValueError(f"{key} {k}: components or length out of range")
                v = v.astype("<i4")
                out.append((k, v.tobytes(), int((v.astype(np.int64) ** 2).sum())))
            cols = list(zip(*out)) if out else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return rows.select(F.col(key).cast("long"), F.col(vector).cast("array<double>")).mapInArrow(run, CLEAN)


def _matrix(vectors: list[bytes], dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        x = np.frombuffer(v, "<i4")
        out[i, :len(x)] = x
    return out


def _raised(x: np.ndarray, most: float) -> np.ndarray:
    """Indexed vectors with the extra coordinate."""
    return np.hstack([x, np.sqrt(np.maximum(most - (x * x).sum(1), 0))[:, None]])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(d, 0))


def far_apart(x: np.ndarray, n: int) -> np.ndarray:
    """Up to n rows, each the furthest from those before it."""
    chosen, gap = [0], np.full(len(x), np.inf)
    while len(chosen) < min(n, len(x)):
        gap = np.minimum(gap, _distances(x, x[chosen[-1:]])[:, 0])
        if gap.max() <= 0:
            break
        chosen.append(int(gap.argmax()))
    return x[chosen]


class Best:
    """The k best (score, smaller id first) of each query of a block."""

    def __init__(self, ids: np.ndarray, floor: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.score = np.full((len(ids), k), -np.inf)
        self.vec = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.floor = floor.copy()  # a k-th best score is at least this

    def add(self, rows: np.ndarray, vec: np.ndarray, scores: np.ndarray) -> None:
        scores = np.where(self.ids[rows][:, None] == vec[None], -np.inf, scores)
        some = (scores >= self.floor[rows][:, None]).any(1)
        rows, scores = rows[some], scores[some]
        if not len(rows):
            return
        all_s = np.hstack([self.score[rows], scores])
        all_v = np.hstack([self.vec[rows], np.broadcast_to(vec, scores.shape)])
        order = np.lexsort((all_v, -all_s), axis=1)[:, :self.k]
        self.score[rows] = np.take_along_axis(all_s, order, 1)
        self.vec[rows] = np.take_along_axis(all_v, order, 1)
        self.floor[rows] = np.maximum(self.floor[rows], self.score[rows, -1])

    def rows(self, block: int) -> list[np.ndarray]:
        q, r = np.nonzero(np.isfinite(self.score))
        return [np.full(len(q), block, np.int64), q.astype(np.int32), self.ids[q], self.vec[q, r],
                self.score[q, r].astype(np.int64)]


def top_k(rows: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best of every query row."""
    spark = rows.sparkSession
    small_batches(spark, 4096)
    clean = stage(quantised(rows, scale), "vectors")
    facts = clean.agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("most"),
                      F.max(F.length("v")).alias("width")).first()
    n, most, dim = facts["n"], float(facts["most"] or 0), max(1, (facts["width"] or 0) // 4)
    # a component is at most as long as its vector
    held_as = next(t for t, bound in (("<i1", 1 << 7), ("<i2", 1 << 15), ("<i4", np.inf)) if most < bound * bound)
    # rounding of sums up to `most`, in scores and in distances
    slack, gap_slack = 1e-3 + 1e-13 * most, 1e-6 + 1e-6 * most ** 0.5
    share = F.lit(int(min(1, SAMPLE / max(1, n)) * (1 << 60)))
    drawn = clean.where(key_hash60("vec_id") < share).orderBy("vec_id", "v").limit(4 * SAMPLE).toArrow()
    sample_ids = drawn["vec_id"].to_numpy().astype(np.int64)
    sample = _matrix(drawn["v"].to_pylist(), dim)
    # sample and pivots: bounded by SAMPLE and PIVOTS rows
    known = spark.sparkContext.broadcast((sample_ids, sample))
    pivots = far_apart(_raised(sample, most), PIVOTS) if len(sample) else np.zeros((1, dim + 1))
    keyed_schema, cell_schema, found_schema = pa_schema(KEYED), pa_schema(CELLS), pa_schema(FOUND)

    def keyed(query: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch.column("v").to_pylist(), dim)
                x = np.hstack([x, np.zeros((len(x), 1))]) if query else _raised(x, most)
                d = _distances(x, pivots)
                near = d.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("v"), pa.array(near.astype(np.int32)),
                     pa.array(d[np.arange(len(d)), near])], schema=keyed_schema)
        return run

    def cells_of(query: bool, size: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[tuple] = []

            def cell() -> pa.RecordBatch:
                ids, vs, pivot, dist = zip(*held)
                held.clear()
                x, keys = _matrix(list(vs), dim), np.array(ids, "<i8")
                reach = floor = None
                if query:  # what its longest query can score at most, and the lowest bound
                    reach, floor = float((x * x).sum(1).max()), float(_first_floor(keys, x, *known.value, k).min())
                return pa.RecordBatch.from_arrays(
                    [pa.array([c], f.type) for c, f in zip(
                        (pivot[0], min(dist), max(dist), keys.tobytes(), x.astype(held_as).tobytes(), reach, floor),
                        cell_schema)], schema=cell_schema)

            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    if held and (len(held) == size or held[0][2] != row[2]):
                        yield cell()
                    held.append(row)
            if held:
                yield cell()
        return run

    def cut(some: DataFrame, query: bool, size: int) -> DataFrame:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return (some.select("vec_id", "v").mapInArrow(keyed(query), KEYED)
                .repartitionByRange(parts, "pivot", "dist", "vec_id")
                .sortWithinPartitions("pivot", "dist", "vec_id", "v").mapInArrow(cells_of(query, size), CELLS))

    # numbered once, as written: cells may hold equal rows
    cells = stage(cut(clean, False, CELL).withColumn("cell", F.monotonically_increasing_id()), "annuli")
    # a query block keeps neighbours together; ends of a pivot's queries make small blocks
    asked = stage(cut(clean.where(is_query), True, QUERIES).withColumn("block", F.monotonically_increasing_id()),
                  "query-blocks")
    bundles = max(1, -(-cells.count() // BUNDLE))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, best, done = None, None, False
        q = to_pivots = lengths = None

        def found() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in best.rows(now[0])], schema=found_schema)

        for batch in batches:
            for block, bundle, qids, qvs, pivot, low, high, ids, vs, nearest in zip(
                    *(c.to_pylist() for c in batch.columns)):
                if (block, bundle) != now:
                    if best is not None:
                        yield found()
                    now, done = (block, bundle), False
                    qid = np.frombuffer(qids, "<i8")
                    q = np.frombuffer(qvs, held_as).reshape(-1, dim).astype(float)
                    lengths = (q * q).sum(1)
                    to_pivots = _distances(np.hstack([q, np.zeros((len(q), 1))]), pivots)
                    best = Best(qid, _first_floor(qid, q, *known.value, k), k)
                # the annuli come in the order of `nearest`: none from here on can do better
                done = done or (lengths.max() + most - max(0.0, nearest - gap_slack) ** 2) / 2 + slack < best.floor.min()
                if done:
                    continue
                d = to_pivots[:, pivot]
                least = np.maximum(0, np.maximum(d - high, low - d) - gap_slack)
                reach = (lengths + most - least * least) / 2 + slack
                rows = np.flatnonzero(reach >= best.floor)
                if len(rows):
                    x = np.frombuffer(vs, held_as).reshape(-1, dim).astype(float)
                    best.add(rows, np.frombuffer(ids, "<i8"), q[rows] @ x.T)
        if best is not None:
            yield found()

    # summaries: of annuli by bundle, of blocks once per bundle
    annuli = cells.select("cell", "pivot", "low", "high",
                          F.pmod(F.xxhash64("cell"), F.lit(bundles)).cast("int").alias("bundle"))
    blocks = asked.select("block", F.col("pivot").alias("qpivot"), F.col("high").alias("qhigh"), "reach", "floor",
                          F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))).alias("bundle"))
    gaps = _distances(pivots, pivots)

    @F.pandas_udf("double")
    def least_of(qpivot, qhigh, pivot, low, high):
        """Least distance of any query of a block to any vector of an annulus:
        the queries are within qhigh of their pivot."""
        gap = gaps[qpivot, pivot]
        return np.maximum(0, np.maximum(gap - qhigh - high, low - gap - qhigh))

    near = F.greatest(F.lit(0.0), F.col("least") - gap_slack)
    pairs = (blocks.join(annuli, "bundle").withColumn("least", least_of("qpivot", "qhigh", "pivot", "low", "high"))
             .where((F.col("reach") + most - near * near) / 2 + slack >= F.col("floor"))
             .select("block", "bundle", "cell", "least"))
    pairs = stage(pairs, "open-pairs")
    small_batches(spark, 64)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = (pairs.join(cells.select("cell", "pivot", "low", "high", "ids", "vs"), "cell")
           .join(asked.select("block", F.col("ids").alias("qids"), F.col("vs").alias("qvs")), "block")
           .repartition(parts, "block", "bundle").sortWithinPartitions("block", "bundle", "least")
           .select("block", "bundle", "qids", "qvs", "pivot", "low", "high", "ids", "vs", "least")
           .mapInArrow(search, FOUND))
    rank = F.row_number().over(Window.partitionBy("block", "place").orderBy(F.col("score").desc(), "vec_id"))
    return (met.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _first_floor(qid: np.ndarray, q: np.ndarray, ids: np.ndarray, sample: np.ndarray, k: int) -> np.ndarray:
    """A lower bound on each query's k-th best score, from the sample."""
    if len(sample) <= k:
        return np.full(len(q), -np.inf)
    scores = np.where(qid[:, None] == ids, -np.inf, q @ sample.T)
    return np.partition(scores, len(sample) - k, axis=1)[:, len(sample) - k]

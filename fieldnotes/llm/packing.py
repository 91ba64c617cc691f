"""Best-fit packing of tokenised documents by minimum bin slack.

1. Documents are tokenised where they are read; longer ones are cut into
   pieces of the capacity. Only one narrow row per piece goes on.
2. Pieces of equal length are alike, so the packing is found on the counts
   per length: at most ``capacity`` rows, whatever the input. For each bin
   the longest length left is set, a bitset subset-sum over the lengths left
   finds the fullest combination with it, and that combination is removed as
   often as the counts allow.
3. Each piece gets its rank among the pieces of its length (in sub-buckets,
   so that a very common length is split), and the rank says which bin and
   which place.

Defined results: a NULL or empty text is one piece holding just the end id;
equal rows are packed each on their own; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldnotes.llm.common import pa_schema, small_batches, stage, text_of
from fieldnotes.llm.tokens import encoder

CAPACITY = 2048
BATCH = 512
SUB = 16_384
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PLACED = PIECES + ", sequence_id bigint, offset bigint"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """One row per piece: where its ids start in the document, how many they
    are, and their checksum."""
    small_batches(docs.sparkSession, BATCH)
    schema = pa_schema(PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = enc.pack([end_id])
        for batch in batches:
            rows: list[tuple] = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(enc.encode(text) + end, enc.dtype)
                for n, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at:at + capacity]
                    rows.append((key, n, at, len(part), zlib.crc32(part.astype("<u4").tobytes())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else
                [pa.array([], f.type) for f in schema], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), text_of()).mapInArrow(run, PIECES)


def fullest(counts: list[int], capacity: int, seed: int) -> dict[int, int]:
    """The fullest bin that holds ``seed`` and others of the lengths left.

    ``counts[n]`` is how many pieces of length n are left. Bit s of the set
    says that a sum s is reachable; the sets before each length are kept, to
    read the combination back.
    """
    room = capacity - seed
    full, mask = 1 << room, (1 << (room + 1)) - 1
    reach, trail = 1, []
    for length in range(min(room, seed), 0, -1):
        left = counts[length] - (length == seed)
        if left <= 0:
            continue
        before = reach
        for _ in range(min(left, room // length)):
            grown = (reach | (reach << length)) & mask
            if grown == reach:
                break
            reach = grown
        trail.append((length, before))
        if reach & full:
            break
    rest = reach.bit_length() - 1
    chosen = {seed: 1}
    for length, before in reversed(trail):
        n = 0
        while not (before >> rest) & 1:
            rest -= length
            n += 1
        if n:
            chosen[length] = chosen.get(length, 0) + n
    return chosen


def patterns(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(combination, bins) until no piece is left: longest length first."""
    counts = [0] * (capacity + 1)
    for length, n in histogram.items():
        counts[length] = n
    out = []
    for seed in range(capacity, 0, -1):
        while counts[seed]:
            chosen = fullest(counts, capacity, seed)
            bins = min(counts[length] // n for length, n in chosen.items())
            for length, n in chosen.items():
                counts[length] -= n * bins
            out.append((chosen, bins))
    return out


def layout(found: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first rank, first bin, copies per bin, first offset),
    in order: the ranks of a length from one row to the next belong to the
    bins of that row's combination."""
    used: dict[int, int] = {}
    rows, bins_before = [], 0
    for chosen, bins in found:
        offset = 0
        for length in sorted(chosen, reverse=True):
            n = chosen[length]
            rows.append((length, used.get(length, 0), bins_before, n, offset))
            used[length] = used.get(length, 0) + n * bins
            offset += n * length
        bins_before += bins
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Sequence and offset of every piece. ``cut`` must be stable (staged)."""
    by_length = cut.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in by_length.collect()}  # at most `capacity` rows
    rows = layout(patterns(histogram, capacity))
    starts = rows[:, 0] << 40 | rows[:, 1]
    subs = max(1, -(-sum(histogram.values()) // SUB))
    sub = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(subs))
    parts = cut.withColumn("_sub", sub)
    before = Window.partitionBy("length").orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (parts.groupBy("length", "_sub").agg(F.count(F.lit(1)).alias("_n"))
               .select("length", "_sub", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    within = Window.partitionBy("length", "_sub").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (parts.withColumn("_rank", F.row_number().over(within) - 1)
              .join(offsets, ["length", "_sub"])
              .select("doc_id", "piece", "start", "length", "ids_crc32",
                      (F.col("_rank") + F.col("_before")).alias("_rank")))
    schema = pa_schema(PLACED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            row = rows[np.searchsorted(starts, length << 40 | rank, side="right") - 1]
            nth = rank - row[:, 1]
            cols = [batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(row[:, 2] + nth // row[:, 3]),
                 pa.array(row[:, 4] + nth % row[:, 3] * length)], schema=schema)

    return ranked.mapInArrow(run, PLACED)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    return place(stage(pieces(docs, tokenizer, capacity, end_id), "pieces"), capacity)

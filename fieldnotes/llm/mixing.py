"""Mixing sources to target weights with hash-threshold histograms.

Every row gets a repeatable 60-bit hash of its key. For each source the
words are summed by hash bucket; the cumulative sums give the bucket in
which the source's budget ends; only that boundary bucket is refined, twelve
bits at a time, until the threshold is a full hash. Rows below the threshold
are taken once more than the whole passes. Where several rows share the key
that the threshold falls on, they are told apart in the same way by a hash of
their text, and rows of one text by their place in the scan. No row is ever
sorted, and the aggregates hold at most sources x 4096 rows whatever the input
size. The plan (a row per source) is written after each level, so that a level
reads the last one's and not all before it.

Only DataFrame functions are used.

Defined results: a NULL text has size 0 and is taken 0 times; very long texts
are counted whole; NULL sources form one source, ordered last; rows that repeat
a key are taken one by one, so a key that holds much of a source leaves it at
most one row below its target (which of several equal rows are taken is left
open, their number is not); an empty table gives an empty result; other
columns, whatever their names, don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldnotes.llm.common import key_hash60, stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
HASH_BITS = 60
LEVEL_BITS = 12
#: What the rows are told apart by, in this order.
ORDER = ("hash", "text_hash", "place")


def word_count(column: str = "text") -> Column:
    """Number of words of a text (NULL: 0)."""
    return F.coalesce(F.regexp_count(F.col(column).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def _order(docs: DataFrame, key: str, text: str) -> list[Column]:
    """The columns of ``ORDER`` (the place as it is in this scan)."""
    return [key_hash60(key).alias("hash"), key_hash60(text).alias("text_hash"),
            F.monotonically_increasing_id().alias("place")]


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, hash, text_hash, place) of every row."""
    return docs.select(F.col(key).alias("doc_id"), F.col(source).cast("string").alias("source"),
                       word_count(text).alias("size"), *_order(docs, key, text))


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            most: int = MOST) -> DataFrame:
    """One row per source: (source, source_size, target).

    Sources in code-point order, NULL last, get the weights in turn. They
    share ``share`` times all words by weight; no target goes above ``most``
    times its source's words. Resharing the excess by weight until none is
    above is a water level: with sources in order of cap/weight, the level is
    the largest of (budget - caps before) / (weights from here on).
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    by_ratio = Window.orderBy("ratio", "place")
    all_rows = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.col("place") % len(weights) + 1).cast("int"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    level = ((F.lit(share) * F.sum("source_size").over(all_rows)
              - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after))
    return (rows.groupBy("source").agg(F.sum("size").alias("source_size"))
            .withColumn("place", F.row_number().over(by_name) - 1)
            .withColumn("weight", weight)
            .withColumn("cap", F.col("source_size") * most)
            .withColumn("ratio", F.col("cap") / F.col("weight"))
            .withColumn("level", level)
            .withColumn("level", F.max("level").over(all_rows))
            .select("source", "source_size",
                    F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target")))


def _refined(rows: DataFrame, at: DataFrame, column: str, edges: list[str], name: str) -> DataFrame:
    """``at`` with ``column`` of the row in which each source's budget ends,
    among the rows that have the edges found before, as ``<column>_edge``."""
    edge = f"{column}_edge"
    at = at.withColumn(edge, F.lit(0).cast("long"))
    kept = [c for c in at.columns if c not in ("base", edge)]
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        above = [rows[c] == F.col(f"_{c}_edge") for c in edges]
        if shift < HASH_BITS - LEVEL_BITS:
            above.append(F.shiftright(rows[column], shift + LEVEL_BITS) == F.col(f"_{edge}"))
        inside = rows
        if above:
            ends = at.select(F.col("source").alias("of"), *[F.col(f"{c}_edge").alias(f"_{c}_edge")
                                                            for c in [*edges, column]])
            match = rows["source"].eqNullSafe(ends["of"])
            for one in above:
                match = match & one
            inside = rows.join(ends, match)
        sums = (inside.groupBy(F.col("source").alias("of"), F.shiftright(column, shift).alias("bucket"))
                .agg(F.sum("size").alias("words")))
        running = F.sum("words").over(Window.partitionBy("of").orderBy("bucket"))
        sums = sums.withColumn("upto", running)
        found = (at.join(sums, at["source"].eqNullSafe(sums["of"]), "left")
                 .withColumn("upto", F.col("base") + F.col("upto"))
                 # the first bucket that goes above the budget
                 .groupBy(*kept)
                 .agg(F.min(F.when(F.col("upto") > F.col("rest"),
                                   F.struct("bucket", (F.col("upto") - F.col("words")).alias("under")))).alias("end"))
                 .select(*kept, F.coalesce("end.under", F.lit(0)).alias("base"), F.col("end.bucket").alias(edge)))
        at = stage(found, f"{name}-level")
    return at


def thresholds(rows: DataFrame, goal: DataFrame, name: str = "mix") -> DataFrame:
    """(source, source_size, target, passes, hash_edge, text_hash_edge,
    place_edge): every row is taken ``passes`` times, rows before the edges
    once more. The later edges are 0 where the first tells the rows apart."""
    at = goal.select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(0).cast("long").alias("passes"))
    at = at.select("*", (F.col("target") - F.col("passes") * F.col("source_size")).alias("rest"),
                   F.lit(0).cast("long").alias("base"))
    edges: list[str] = []
    for column in ORDER:
        at = _refined(rows, at, column, edges, name)
        edges.append(column)
        # does an edge fall on several rows that hold words?
        match = rows["source"].eqNullSafe(F.col("of"))
        for c in edges:
            match = match & (rows[c] == F.col(f"_{c}_edge"))
        ends = at.select(F.col("source").alias("of"), *[F.col(f"{c}_edge").alias(f"_{c}_edge") for c in edges])
        shared = rows.where("size > 0").join(ends, match).groupBy("of").count().where("count > 1")
        if shared.isEmpty():
            break
    return at.select("source", "source_size", "target", "passes",
                     *[F.col(f"{c}_edge") if c in edges else F.lit(0).cast("long").alias(f"{c}_edge") for c in ORDER])


def times() -> Column:
    """How often a row is taken, from its ``ORDER`` columns and its source's plan."""
    before = F.lit(False)
    for c in reversed(ORDER):
        at, edge = F.col(c), F.col(f"{c}_edge")
        before = (at < edge) | ((at == edge) & before)
    return F.col("passes") + F.coalesce(before, F.lit(False)).cast("long")


def mix(rows: DataFrame, name: str = "mix") -> DataFrame:
    """``sized`` rows with source_size, target and taken words."""
    rows = stage(rows, f"{name}-sizes")
    plan = stage(thresholds(rows, targets(rows), name), f"{name}-plan")
    joined = rows.join(plan.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    return joined.select("doc_id", "source", "size", "source_size", "target",
                         (F.col("size") * times()).alias("taken"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """The documents themselves, each row repeated as often as the mix takes
    it. The text isn't shuffled: the per-source plan is joined to it. ``docs``
    is read twice and should be a scan, so that rows that repeat a key and a
    text keep their places."""
    rows = stage(sized(docs), "mix-sizes")
    plan = stage(thresholds(rows, targets(rows)), "mix-plan").withColumnRenamed("source", "_of")
    cols = docs.columns
    keyed = docs.select(F.struct(*[docs[c] for c in cols]).alias("_doc"),
                        docs["source"].cast("string").alias("_source"), *_order(docs, "doc_id", "text"))
    joined = keyed.join(plan, F.col("_source").eqNullSafe(F.col("_of")))
    return (joined.select("_doc", F.explode(F.array_repeat(F.lit(1), times().cast("int"))).alias("_copy"))
            .select([F.col(f"_doc.`{c}`").alias(c) for c in cols]))

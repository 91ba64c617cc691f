"""Output checks: row positions and the id-order check (R12), and the
extraction of tuning curves from trial logs (M12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldnotes.operators.search import materialize

_SHIFT = 33  # monotonically_increasing_id = partition index << 33 | row in partition
BROADCAST_ROWS = 100_000  # of an offset table; beyond it the join is shuffled


def with_position(df: DataFrame, order_by: list | None = None,
                  position: str = "position", keep: str = "checkpoint") -> DataFrame:
    """Add a 0-based row position without moving rows to one task.

    The rows are (optionally) sorted -- a range-partitioned sort -- and
    tagged with partition index and in-partition row number in the same
    pass, then kept (``checkpoint`` by default, into the shared folder) so
    the partitioning both uses see is the same. Partition sizes give
    offsets (``_offsets``).

    Without ``order_by`` positions follow the scan order of the source.
    """
    src = df.orderBy(*order_by) if order_by else df
    tagged = materialize(
        src.withColumn("__pid", F.spark_partition_id())
           .withColumn("__mid", F.monotonically_increasing_id()), keep)
    sizes = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    local = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), _SHIFT)
    return (tagged.join(_offsets(sizes, ["__pid"], keep), "__pid")
            .withColumn(position, (F.col("__off") + local).cast("long"))
            .drop("__pid", "__mid", "__off"))


def _offsets(sizes: DataFrame, by: list[str], keep: str = "checkpoint") -> DataFrame:
    """``sizes`` (a row per partition or split, ``__n`` rows each) with
    ``__off``, the rows before it in the order ``by``, in place of ``__n``.

    The table grows with the input, so its running totals are taken on two
    levels (``prefix_sums``: within key ranges, and over the ranges, of which
    there are as many as shuffle partitions). It is broadcast up to
    ``BROADCAST_ROWS`` rows, joined by a shuffle beyond.
    """
    summed = materialize(prefix_sums(sizes, by, ["__n"], keep)
                         .withColumnRenamed("__n_before", "__off").drop("__n", "__n_total", "position"), keep)
    return F.broadcast(summed) if summed.count() <= BROADCAST_ROWS else summed


def prefix_sums(df: DataFrame, order_by: list[str], cols: list[str],
                keep: str = "checkpoint") -> DataFrame:
    """Running totals in a global order without a single-task window.

    Adds ``position`` (0-based), and per column ``c``: ``c_before`` (sum
    over all earlier rows) and ``c_total``. The rows are range-partitioned
    by the order, kept (so both uses see one partitioning), totalled per
    partition (one row per partition: offsets, broadcast), and summed
    within each partition. ``order_by`` should be unique per row.
    """
    tagged = materialize(df.orderBy(*order_by)
                         .withColumn("__range", F.spark_partition_id()), keep)
    sizes = tagged.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"),
                                        *[F.sum(c).alias(f"__s_{c}") for c in cols])
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    offsets = sizes.select(
        "__range", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__off_n"),
        *[F.coalesce(F.sum(f"__s_{c}").over(earlier), F.lit(0)).alias(f"__off_{c}")
          for c in cols],
        *[F.sum(f"__s_{c}").over(every).alias(f"{c}_total") for c in cols])
    inner = Window.partitionBy("__range").orderBy(*order_by)
    inner_before = inner.rowsBetween(Window.unboundedPreceding, -1)
    out = tagged.join(F.broadcast(offsets), "__range").withColumn(
        "position", (F.col("__off_n") + F.row_number().over(inner) - 1).cast("long"))
    for c in cols:
        out = out.withColumn(f"{c}_before", F.col(f"__off_{c}")
                             + F.coalesce(F.sum(c).over(inner_before), F.lit(0)))
    return out.drop("__range", "__off_n", *[f"__off_{c}" for c in cols])


def _positioned(df: DataFrame, id_col: str, alias: str, order: list | None) -> DataFrame:
    order = list(order or [])
    keep = [F.col(id_col).alias(alias)] + [F.col(c) for c in order if c != id_col]
    by = [alias if c == id_col else c for c in order]
    return with_position(df.select(*keep), by or None).select("position", alias)


FILE_ORDER = ["__file", "__split", "__row"]


def file_order(df: DataFrame) -> DataFrame:
    """Add columns that order the rows of a scan as in their files: file name,
    start of the split, then place in the task (a task reads a split in order;
    which splits it reads depends on sizes, not names). ``df`` must be the
    scan itself."""
    return df.select("*", F.col("_metadata.file_path").alias("__file"),
                     F.col("_metadata.file_block_start").alias("__split"),
                     F.monotonically_increasing_id().alias("__row"))


def file_positions(df: DataFrame, position: str = "position") -> DataFrame:
    """0-based row positions over all files of a scan, without sorting rows
    that lie in order already: counts per split (one row each) give the
    offsets (``_offsets``)."""
    tagged = file_order(df)
    splits = tagged.groupBy("__file", "__split").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__row").alias("__first"))
    return (tagged.join(_offsets(splits, ["__file", "__split"]), ["__file", "__split"])
            .withColumn(position, F.col("__off") + F.col("__row") - F.col("__first"))
            .drop(*FILE_ORDER, "__off", "__first"))


def id_order_check(inputs: DataFrame, outputs: DataFrame, id_col: str,
                   input_order: list | None = None,
                   output_order: list | None = None) -> DataFrame:
    """Compare ids of two tables by position and as multisets.

    Returns ``metric, n``: ``n_input``, ``n_output``, ``n_mismatch``
    (positions whose ids differ, or present on one side only),
    ``n_missing`` (input ids not in the output) and ``n_extra``.
    """
    a = _positioned(inputs, id_col, "in_id", input_order)
    b = _positioned(outputs, id_col, "out_id", output_order)
    return compare_positions(a, b)


def compare_positions(a: DataFrame, b: DataFrame) -> DataFrame:
    """The metrics of ``id_order_check`` for two positioned tables,
    ``position, in_id`` and ``position, out_id``: one shuffle by position, one
    by id."""
    joined = a.join(b, "position", "full_outer")
    differs = ~F.col("in_id").eqNullSafe(F.col("out_id"))
    by_position = joined.agg(
        F.count("in_id").alias("n_input"),
        F.count("out_id").alias("n_output"),
        F.sum(differs.cast("long")).alias("n_mismatch"))
    long = by_position.unpivot([], ["n_input", "n_output", "n_mismatch"], "metric", "n")
    # +1 for each input id, -1 for each output id: what is left over
    balance = (a.select(F.col("in_id").alias("id"), F.lit(1).alias("d"))
               .union(b.select(F.col("out_id").alias("id"), F.lit(-1).alias("d")))
               .groupBy("id").agg(F.sum("d").alias("d"))
               .agg(F.coalesce(F.sum(F.greatest("d", F.lit(0))), F.lit(0)).alias("n_missing"),
                    F.coalesce(F.sum(F.greatest(-F.col("d"), F.lit(0))), F.lit(0)).alias("n_extra")))
    return long.unionByName(balance.unpivot([], ["n_missing", "n_extra"], "metric", "n"))


def extract_curve(lines: DataFrame, pattern: str, column: str = "value") -> DataFrame:
    """``x, y`` from log lines matching ``pattern`` (two groups) at the
    start of the line; other lines are skipped."""
    anchored = f"^(?:{pattern})"
    c: Column = F.col(column)
    return (lines.filter(c.rlike(anchored))
            .select(F.regexp_extract(c, anchored, 1).try_cast("double").alias("x"),
                    F.regexp_extract(c, anchored, 2).try_cast("double").alias("y")))

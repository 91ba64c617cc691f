"""Per-feature measures: mean (A1), mode (A2), Pearson score (A3) and
chi-squared score (A4), and the ranking order (O1).

Inputs are long forms from ``operators.parse``. Each measure is one
``groupBy('feature')`` (two for the discrete ones): Catalyst plans a
partial hash aggregate before the shuffle, so each task ships at most one
row per feature (per feature and category) whatever the row count, and a
feature or category holding most rows is summed map-side, not in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldnotes.functions.cells import finite_or_zero, quote_ident, sql_str



def _v() -> Column:
    return F.col("value")


def _y() -> Column:
    return F.col("label_count")


def feature_means(cells: DataFrame) -> DataFrame:
    """``feature, n, mean`` over non-missing cells (zeros included)."""
    return (cells.groupBy("feature")
            .agg(F.count(_v()).alias("n"), F.avg(_v()).alias("mean")))


#: A spread below this share of the mean is rounding: the values are constant.
#: (Merging partial moments rounds the mean, so a constant's variance is some
#: 1e-32 of its square, not 0.)
FLAT = 1e-13


def _spread(variance: Column, mean: Column) -> Column:
    """Standard deviation; 0 where it is rounding only."""
    return F.when(variance <= mean * mean * F.lit(FLAT * FLAT), F.lit(0.0)).otherwise(F.sqrt(variance))


def _every_feature(scored: DataFrame, features: list[str] | None, label: str) -> DataFrame:
    """A row for each asked feature; one without any cell scores 0."""
    scored = scored.filter(F.col("feature") != label)
    if features is None:
        return scored
    names = [(f,) for f in features if f != label]
    asked = scored.sparkSession.createDataFrame(names, "feature string")
    return (asked.join(scored, "feature", "left")
            .select("feature", F.coalesce("score", F.lit(0.0)).alias("score")))


def pearson_scores(cells: DataFrame, label: str, pairwise: bool = False,
                   features: list[str] | None = None) -> DataFrame:
    """``feature, score``: |correlation| of each feature with the raw label
    count, label left out; an undefined or infinite score is 0. With
    ``features``, each of them has a row, also one whose cells are all missing.

    Default: moments over the rows where the feature is present, with the
    label's mean taken over all labelled rows (the original definition:
    ``cov = Sxy/n - xbar*ybar``, ``sx = sqrt(Sxx/n - xbar^2)``,
    ``sy = sqrt(Syy/n - ybar^2)``). It is computed from central moments, with
    the shift ``d = mean(y where present) - ybar``: ``cov = cov_n + xbar*d`` and
    ``sy^2 = var_n(y) + d*(mean + ybar)``, so a constant scores exactly 0.
    ``pairwise=True`` is the textbook correlation over the same rows. The two
    agree when nothing is missing.

    One pass: the cells include the label's own cells, so the same per-feature
    aggregate gives the label mean. It is spread to the other rows by a window
    over that aggregate, which has one row per feature -- bounded by the schema
    width, not the data.
    """
    sums = cells.filter(_y().isNotNull()).groupBy("feature").agg(
        F.avg(_v()).alias("mx"), F.var_pop(_v()).alias("vx"),
        F.avg(F.when(_v().isNotNull(), _y())).alias("my"),
        F.var_pop(F.when(_v().isNotNull(), _y())).alias("vy"),
        F.covar_pop(_v(), _y()).alias("cxy"))
    if pairwise:
        r = F.try_divide(F.col("cxy"), _spread(F.col("vx"), F.col("mx")) * _spread(F.col("vy"), F.col("my")))
    else:
        own = F.when(F.col("feature") == label, F.col("mx"))
        sums = sums.withColumn("ybar", F.max(own).over(Window.partitionBy()))
        d = F.col("my") - F.col("ybar")
        vy = F.col("vy") + d * (F.col("my") + F.col("ybar"))
        r = F.try_divide(F.col("cxy") + F.col("mx") * d,
                         _spread(F.col("vx"), F.col("mx")) * _spread(vy, F.col("my")))
    scored = sums.select("feature", F.abs(finite_or_zero(r)).alias("score"))
    return _every_feature(scored, features, label)


ROW_MARKER = "__row"


def _by_feature(stats: DataFrame, features: list[str], totals: dict[str, str]) -> DataFrame:
    """A row of ``stats`` for each of ``features`` (zeros where it has none),
    with figures of the row marker under the names ``totals`` gives.

    ``stats`` has one row per feature, so it is bounded by the schema: it is
    made one map, from which the asked features are looked up. That is one small
    exchange; a join with the names and windows for the totals are several.
    """
    own = [c for c in stats.columns if c != "feature"]
    one = stats.agg(F.expr(f"map_from_entries(collect_list(struct(feature, struct({', '.join(own)}))))").alias("m"))
    rows = one.selectExpr("m", f"explode(array({', '.join(map(sql_str, features))})) AS feature")
    return rows.selectExpr("feature", *[f"coalesce(m[feature].{c}, 0) AS {c}" for c in own],
                           *[f"coalesce(m['{ROW_MARKER}'].{c}, 0) AS {name}" for name, c in totals.items()])


def sparse_measures(cells: DataFrame, features: list[str], label: str | None = None) -> DataFrame:
    """``feature, n, mean[, score]`` for every one of ``features``, from sparse
    cells (see ``parse.sparse_cells``) in one aggregate: the numbers that
    ``feature_means`` and ``pearson_scores`` give on zero-filled cells.

    A feature has k non-zero cells and m missing ones; the other N - m - k rows
    are zeros, which have no cell. Moments over the N - m rows where it is
    present are put together from those of the non-zero cells, of the zeros,
    and (for the label) of all rows without the missing ones. A feature without
    any cell is all zeros.
    """
    scored = label is not None
    null = _v().isNull()
    aggs = [F.count(F.lit(1)).alias("cells"), F.sum(null.cast("long")).alias("missing"), F.sum(_v()).alias("sx")]
    if scored:
        has = _y().isNotNull()
        x = F.when(has, _v())
        aggs += [
            F.sum(has.cast("long")).alias("l_cells"), F.sum((has & null).cast("long")).alias("l_missing"),
            F.count(x).alias("k"), F.avg(x).alias("x1"), F.var_pop(x).alias("x2"), F.covar_pop(x, _y()).alias("xy"),
            F.avg(F.when(~null, _y())).alias("y1"),
            F.avg(F.when(null, _y())).alias("m1"), F.var_pop(F.when(null, _y())).alias("m2"),
            F.avg(_y()).alias("a1"), F.var_pop(_y()).alias("a2")]
    return _measured(cells.groupBy("feature").agg(*aggs), features, scored)


def _measured(stats: DataFrame, features: list[str], scored: bool) -> DataFrame:
    """``feature, n, mean[, score]`` put together from the figures of each
    feature's non-zero and missing cells, and of the row marker."""
    t = _by_feature(stats, features,
                    {"rows": "cells", **({"l_rows": "l_cells", "ybar": "a1", "yvar": "a2"} if scored else {})})
    n = F.coalesce("rows", F.lit(0)) - F.col("missing")
    out = [F.col("feature"), n.alias("n"), F.try_divide(F.col("sx"), n).alias("mean")]
    if not scored:
        return t.select(*out)
    c = lambda name: F.col(name).cast("double")
    div = F.try_divide
    t = t.withColumn("p", c("l_rows") - c("l_missing"))  # labelled rows where present
    t = t.withColumn("z", F.col("p") - c("k"))  # of these, zeros
    t = t.withColumn("y_sum", c("l_rows") * F.col("ybar") - c("l_missing") * F.col("m1"))
    t = t.withColumn("yp", div("y_sum", "p"))
    t = t.withColumn("yz", F.coalesce(div(F.col("y_sum") - c("k") * F.col("y1"), F.col("z")), F.lit(0.0)))
    t = t.withColumn("mx", div(c("k") * F.col("x1"), F.col("p")))
    mixed = div(c("k") * F.col("z"), F.col("p"))
    t = t.withColumn("vx", div(c("k") * F.col("x2") + mixed * F.col("x1") * F.col("x1"), F.col("p")))
    t = t.withColumn("cxy", div(c("k") * F.col("xy") + mixed * F.col("x1") * (F.col("y1") - F.col("yz")), F.col("p")))
    gone = F.coalesce(div(F.col("p") * c("l_missing"), c("l_rows")), F.lit(0.0)) * F.pow(F.col("yp") - F.col("m1"), 2)
    t = t.withColumn("vy", div(c("l_rows") * F.col("yvar") - c("l_missing") * F.col("m2") - gone, F.col("p")))
    d = F.col("yp") - F.col("ybar")
    vy = F.col("vy") + d * (F.col("yp") + F.col("ybar"))
    r = div(F.col("cxy") + F.col("mx") * d, _spread(F.col("vx"), F.col("mx")) * _spread(vy, F.col("yp")))
    return t.select(*out, F.abs(finite_or_zero(r)).alias("score"))


#: Partial figures of a feature (or the row marker): counts, sums, and means
#: with their summed squares or products around them.
_COUNTS = ("cells", "missing", "l_cells", "l_missing", "k")
_PARTIAL = (*_COUNTS, "sx", "x1", "x2", "y1", "xy", "m1", "m2", "a1", "a2")
#: (count, mean, mean, products around the two) of each group of figures
_MOMENTS = (("k", "x1", "x1", "x2"), ("k", "x1", "y1", "xy"), ("l_missing", "m1", "m1", "m2"),
            ("l_cells", "a1", "a1", "a2"))
_STATS = "feature string, " + ", ".join(f"{c} {'bigint' if c in _COUNTS else 'double'}" for c in _PARTIAL)


def _joined(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Figures of two parts of the rows, put together."""
    out = {c: a[c] + b[c] for c in (*_COUNTS, "sx")}
    for n, u, v, products in _MOMENTS:
        share = b[n] / np.maximum(out[n], 1)
        du, dv = b[u] - a[u], b[v] - a[v]
        out[products] = a[products] + b[products] + a[n] * share * du * dv
        out[u], out[v] = a[u] + share * du, a[v] + share * dv
    return out


def _moments(u: np.ndarray, w: np.ndarray) -> tuple[float, float, float, float]:
    """Both means, the squares around the first and the products around both."""
    if not len(u):
        return 0.0, 0.0, 0.0, 0.0
    mean_u, mean_w = u.mean(), w.mean()
    du = u - mean_u
    return mean_u, mean_w, du @ du, du @ (w - mean_w)


def _figures(columns: list[np.ndarray], y: np.ndarray) -> dict[str, np.ndarray]:
    """Figures of a batch, a column per feature and the labels ``y`` (NaN is
    missing). Only non-zero and missing cells are gone through."""
    out = {c: np.zeros(len(columns) + 1, np.int64 if c in _COUNTS else float) for c in _PARTIAL}
    labelled = ~np.isnan(y)
    whole = labelled.all()
    for f, column in enumerate(columns):
        at = np.flatnonzero(column)
        u, label = column[at], y[at]
        null = np.isnan(u)
        if null.any():
            gone = label[null] if whole else label[null & labelled[at]]
            out["missing"][f], out["l_missing"][f] = np.count_nonzero(null), len(gone)
            out["m1"][f], _, out["m2"][f], _ = _moments(gone, gone)
            u, label, at = u[~null], label[~null], at[~null]
        out["sx"][f] = u.sum()
        if not whole:
            u, label = u[labelled[at]], label[labelled[at]]
        out["k"][f] = len(u)
        out["x1"][f], out["y1"][f], out["x2"][f], out["xy"][f] = _moments(u, label)
    own = y[labelled]  # the row marker is last
    out["cells"][-1], out["l_cells"][-1] = len(y), len(own)
    out["a1"][-1], _, out["a2"][-1], _ = _moments(own, own)
    return out


def wide_stats(wide: DataFrame, features: list[str], label: str | None = None) -> DataFrame:
    """The aggregate of sparse cells (``sparse_measures``) from one scan of a
    wide table, whatever its width.

    Unpivoted cells need a narrow ``Expand`` to stay compiled, so a wide table
    is scanned once per slice of columns. Here a task takes its rows as Arrow
    batches, adds up the non-zero and missing cells of all columns at once, and
    hands on one row per feature, as a partial aggregate does. Those rows meet
    by feature and are joined one after another, means with the squares around
    them, so nothing is lost to rounding and a task holds one feature's figures.
    """
    y = f"CAST({quote_ident(label)} AS DOUBLE)" if label else "CAST(NULL AS DOUBLE)"
    base = wide.selectExpr(f"{y} AS __y", *[f"CAST({quote_ident(c)} AS DOUBLE) AS {quote_ident(f'__{i}')}"
                                            for i, c in enumerate(features)])
    schema = pa.schema([("feature", pa.string()), *((c, pa.int64() if c in _COUNTS else pa.float64()) for c in _PARTIAL)])
    names = [*features, ROW_MARKER]

    def rows(feature: list[str], figures: dict[str, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(feature), *(pa.array(figures[c], schema.field(c).type) for c in _PARTIAL)],
                                          schema=schema)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows:
                y, *columns = [c.to_numpy(zero_copy_only=False).astype(float, copy=False) for c in batch.columns]
                got = _figures(columns, y)
                held = _joined(held, got) if held else got
        if held:
            yield rows(names, held)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in batches:
            columns = {c: batch.column(c).to_numpy() for c in _PARTIAL}
            for i, feature in enumerate(batch.column("feature").to_pylist()):
                got = {c: x[i:i + 1] for c, x in columns.items()}
                if feature == at:
                    held = _joined(held, got)
                    continue
                if held:
                    yield rows([at], held)
                at, held = feature, got
        if held:
            yield rows([at], held)

    joined = (base.mapInArrow(add_up, _STATS).repartition("feature").sortWithinPartitions("feature")
              .mapInArrow(join, _STATS))
    per = lambda products, n: F.try_divide(F.col(products), F.col(n)).alias(products)
    return joined.select("feature", *_COUNTS, "sx", "x1", per("x2", "k"), "y1", per("xy", "k"), "m1",
                         per("m2", "l_missing"), "a1", per("a2", "l_cells"))


def wide_measures(wide: DataFrame, features: list[str], label: str | None = None) -> DataFrame:
    """``feature, n, mean[, score]`` of every one of ``features``, as
    ``sparse_measures`` gives them, from one scan of the wide table."""
    return _measured(wide_stats(wide, features, label), features, label is not None)


def feature_means_sparse(cells: DataFrame, features: list[str]) -> DataFrame:
    """``feature, n, mean`` of every feature, from sparse cells."""
    return sparse_measures(cells, features)


def pearson_scores_sparse(cells: DataFrame, label: str, features: list[str]) -> DataFrame:
    """``pearson_scores`` (default definition) of every feature but the label,
    from sparse cells."""
    return (sparse_measures(cells, [f for f in features if f != label], label)
            .select("feature", "score"))


def chi_squared_scores(cat_cells: DataFrame) -> DataFrame:
    """``feature, score``: chi-squared statistic of the category x
    (label = 0 / label > 0) table of each discrete feature.

    NULL when one label class has no rows (the statistic is 0/0 then).
    """
    c = cat_cells.filter(_y().isNotNull())
    table = c.groupBy("feature", "category").agg(
        F.sum((_y() == 0).cast("long")).alias("n0"),
        F.sum((_y() != 0).cast("long")).alias("n1"))
    # totals: one row per feature, so no task holds one feature's whole table
    totals = table.groupBy("feature").agg(F.sum("n0").cast("double").alias("t0"),
                                          F.sum("n1").cast("double").alias("t1"))
    table = table.join(totals, "feature")
    total = F.col("t0") + F.col("t1")
    share = (F.col("n0") + F.col("n1")) / total
    e0 = share * F.col("t0")
    e1 = share * F.col("t1")
    d0 = F.col("n0") - e0
    d1 = F.col("n1") - e1
    term = F.try_divide(d0 * d0, e0) + F.try_divide(d1 * d1, e1)
    return table.groupBy("feature").agg(
        F.when((F.min("t0") > 0) & (F.min("t1") > 0), F.sum(term)).alias("score"))


def feature_modes(cat_cells: DataFrame) -> DataFrame:
    """``feature, mode, mode_count``: most frequent category; ties go to
    the alphabetically first name (= lowest dictionary code)."""
    counts = cat_cells.groupBy("feature", "category").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("feature").agg(
        F.min(F.struct((-F.col("n")).alias("neg"), F.col("category").alias("category")))
        .alias("best"))
    return best.select("feature", F.col("best.category").alias("mode"),
                       (-F.col("best.neg")).alias("mode_count"))


def rank_scores(scores: DataFrame) -> DataFrame:
    """Descending score, feature name as tie-break (NULL scores last)."""
    return scores.orderBy(F.desc_nulls_last("score"), F.asc("feature"))

"""Class counts (A7), train/holdout split (R4), under- (R5) and
oversampling (R6), row sampling (R11).

Two ways to draw:

* ``method='hash'`` (default): a row's draw is ``uniform(key, salt)``, a
  pure function of its key. Results do not depend on partitioning, task
  retries or lost executors (a recomputed partition draws the same rows),
  and can be checked by SQL.
* ``method='poisson'`` (oversampling): with replacement. A row's number of
  copies is the Poisson quantile of its ``uniform(key)``, so it is as
  repeatable as the hash draw.
* ``method='random'``: Spark's seeded samplers (``randomSplit``,
  ``sampleBy``, ``sample``) -- per-row Bernoulli / Poisson draws.

Balancing needs the two class sizes first: one aggregate job (partial
counts per task, two numbers to the driver), then the sampling pass with
the fractions as literals -- a flat filter (or explode) that stays in
whole-stage code generation, with no shuffle.
"""

from __future__ import annotations

import logging
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldnotes.functions.hashing import uniform

log = logging.getLogger(__name__)

SAMPLE_SALT = "sample"


def _y(label_count: str) -> Column:
    return F.col(label_count)


def class_counts(df: DataFrame, label_count: str = "label_count") -> DataFrame:
    """``label, n``: rows per binary class; missing labels left out."""
    y = _y(label_count)
    return (df.filter(y.isNotNull())
            .groupBy((y > 0).cast("int").alias("label"))
            .agg(F.count(F.lit(1)).alias("n")))


def hash_split(df: DataFrame, key: str, weights=(0.7, 0.3),
               names=("train", "holdout"), salt: str | None = None,
               part_col: str = "part") -> DataFrame:
    """Tag each row with a part by cumulative weight of ``uniform(key)``.

    Parts are disjoint and complete by construction.
    """
    total = float(sum(weights))
    u = uniform(key, salt)
    bound = 0.0
    expr = None
    for w, name in zip(weights[:-1], names[:-1]):
        bound += w / total
        expr = (F.when(u < F.lit(bound), F.lit(name)) if expr is None
                else expr.when(u < F.lit(bound), F.lit(name)))
    last = F.lit(names[len(weights) - 1])
    return df.withColumn(part_col, last if expr is None else expr.otherwise(last))


def split(df: DataFrame, key: str | None = None, weights=(0.7, 0.3),
          method: str = "hash", seed: int = 42, salt: str = "split") -> list[DataFrame]:
    """Train / holdout (or more) DataFrames."""
    if method == "random":
        return df.randomSplit(list(weights), seed)
    names = [f"p{i}" for i in range(len(weights))]
    tagged = hash_split(df, key, weights, names, salt=salt, part_col="__part")
    return [tagged.filter(F.col("__part") == n).drop("__part") for n in names]


def undersample(df: DataFrame, key: str | None = None, label_count: str = "label_count",
                method: str = "hash", seed: int = 42, salt: str = SAMPLE_SALT,
                sizes: tuple[float, float] | None = None) -> DataFrame:
    """Keep all rows of the smaller class and a sample of the larger one
    at ``minority / majority``. Rows with a missing label are dropped.

    If one class is empty the labelled rows are returned unchanged (a
    ratio of 0 or infinity would otherwise drop everything). ``sizes``: the
    class sizes, where they are known already (``part_sizes``).
    """
    y = _y(label_count)
    labelled = df.filter(y.isNotNull())
    n0, n1 = sizes or class_sizes(labelled, label_count)
    if n0 == 0 or n1 == 0:
        log.warning("undersample: one class is empty; rows returned unchanged")
        return labelled
    # the larger class is kept at rate small / large; ties keep everything
    majority_is_neg = n1 < n0
    rate = n1 / n0 if majority_is_neg else n0 / n1
    if method == "random":
        fractions = {0: rate, 1: 1.0} if majority_is_neg else {0: 1.0, 1: rate}
        return (labelled.withColumn("__cls", (y > 0).cast("int"))
                .sampleBy("__cls", fractions, seed).drop("__cls"))
    minority = (y > 0) if majority_is_neg else (y == 0)
    return labelled.filter(minority | (uniform(key, salt) < F.lit(rate)))


def oversample(df: DataFrame, key: str | None = None, label_count: str = "label_count",
               method: str = "hash", seed: int = 42, salt: str = SAMPLE_SALT,
               copy_col: str = "copy") -> DataFrame:
    """Repeat the smaller class up to the size of the larger one.

    ``hash``: a minority row gets ``floor(r)`` copies plus one more when
    ``uniform(key) < r - floor(r)`` (``r`` = majority / minority), numbered
    in ``copy_col``; no shuffle, output grows by the minority's share only.
    ``poisson``: Poisson(r) copies per row, as a draw with replacement gives
    them, by ``poisson_copies``; a row drawn 0 times is left out.
    ``random``: Poisson(r) copies per row (``sample`` with replacement).
    """
    y = _y(label_count)
    labelled = df.filter(y.isNotNull())
    n0, n1 = class_sizes(labelled, label_count)
    if n0 == 0 or n1 == 0:
        log.warning("oversample: one class is empty; rows returned unchanged")
        return labelled.withColumn(copy_col, F.lit(0))
    minority = (y > 0) if n0 > n1 else (y == 0)
    r = max(n0, n1) / min(n0, n1)
    if method == "random":
        return labelled.filter(~minority).unionByName(
            labelled.filter(minority).sample(True, r, seed))
    if method == "poisson":
        drawn, copies = poisson_copies(labelled, key, r, salt)
        k = F.when(minority, copies).otherwise(F.lit(1))
        return _repeated(drawn.withColumn("__k", k.cast("int")), copy_col).select(*labelled.columns, copy_col)
    whole = math.floor(r)
    extra = F.when(uniform(key, salt) < F.lit(r - whole), 1).otherwise(0)
    k = F.when(minority, F.lit(whole) + extra).otherwise(F.lit(1))
    return _repeated(labelled.withColumn("__k", k.cast("int")), copy_col)


def _repeated(df: DataFrame, copy_col: str) -> DataFrame:
    """Each row ``__k`` times, numbered from 0."""
    return (df.filter(F.col("__k") > 0)
            .withColumn(copy_col, F.explode(F.sequence(F.lit(0), F.col("__k") - 1)))
            .drop("__k"))


#: One uniform number serves rates up to this; larger ones are split, as sums
#: of independent Poisson counts are Poisson.
POISSON_RATE = 32.0


def poisson_quantiles(rate: float) -> list[float]:
    """P(count <= 0), P(count <= 1), ... until nothing is left in a double."""
    out, term, total, k = [], math.exp(-rate), 0.0, 0
    while total + term > total or k <= rate:
        total += term
        out.append(total)
        k += 1
        term *= rate / k
    return out


def poisson_copies(df: DataFrame, key: str, rate: float, salt: str | None = None) -> tuple[DataFrame, Column]:
    """``df`` with the uniform numbers it needs, and the Poisson(rate) count of
    each row as a column of it: how many quantiles its number has reached.
    The numbers are columns of their own, as a key's hash should be made once
    per row and not once per quantile."""
    parts = max(1, math.ceil(rate / POISSON_RATE))
    reached = poisson_quantiles(rate / parts)
    df = df.withColumns({f"__u{i}": uniform(key, salt if i == 0 else f"{salt or ''}#{i}") for i in range(parts)})
    one = lambda u: ("CASE " + " ".join(f"WHEN {u} < {c!r}D THEN {k}" for k, c in enumerate(reached))
                     + f" ELSE {len(reached)} END")
    return df, F.expr(" + ".join(f"({one(f'__u{i}')})" for i in range(parts)))


def hash_sample(df: DataFrame, key: str, rate: float, salt: str | None = None) -> DataFrame:
    """Keep each row with probability ``rate`` by the hash of its key."""
    return df.filter(uniform(key, salt) < F.lit(float(rate)))


def class_sizes(labelled: DataFrame, label_count: str = "label_count") -> tuple[float, float]:
    """(negatives, positives) among labelled rows: one aggregate job."""
    y = _y(label_count)
    row = labelled.agg(F.sum((y == 0).cast("long")).alias("n0"),
                       F.sum((y > 0).cast("long")).alias("n1")).first()
    return float(row["n0"] or 0), float(row["n1"] or 0)


def part_sizes(df: DataFrame, part_col: str = "part",
               label_count: str = "label_count") -> dict[str, tuple[float, float]]:
    """(negatives, positives) of every part: one grouped aggregate."""
    y = _y(label_count)
    rows = (df.filter(y.isNotNull()).groupBy(part_col)
            .agg(F.sum((y == 0).cast("long")).alias("n0"), F.sum((y > 0).cast("long")).alias("n1")).collect())
    return {r[part_col]: (float(r["n0"]), float(r["n1"])) for r in rows}

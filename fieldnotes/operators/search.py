"""Feature selection and tuning by train / holdout trials (M6-M8), with a
trial table (M10, M11), candidate filter (P13, O3) and best trial (O4).

Vectors with every candidate are assembled once and kept (persisted, or
checkpointed into the shared folder); each trial only slices them
(``VectorSlicer``) and fits a forest. The fits of one round are
independent Spark jobs and run concurrently from a driver thread pool; the
selection rule is then applied to the results in candidate order, so the
outcome does not depend on which fit finishes first. With a ``TrialLedger`` a
search that was stopped takes up the trials done before and fits the others.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldnotes.operators.forest import TUNABLE, ForestParams, accuracy
from fieldnotes.operators.ledger import TrialLedger
from fieldnotes.operators.vectors import slicer, vector_stages, with_binary_label
from fieldnotes.operators.votes import prefix_accuracy, trees_of, with_votes
from fieldnotes.session import checkpoint_root
from fieldnotes.spec import FeatureSpec

log = logging.getLogger(__name__)

TRIAL_SCHEMA = T.StructType([
    T.StructField("search", T.StringType()),
    T.StructField("trial", T.IntegerType()),
    T.StructField("params", T.StringType()),
    T.StructField("accuracy", T.DoubleType()),
])

COIN_TOSS = 0.5


def materialize(df: DataFrame, how: str = "persist") -> DataFrame:
    """Keep a reused frame: ``persist`` (memory and disk; a lost block is
    recomputed from lineage) or ``checkpoint`` (written to the shared
    checkpoint folder; lineage cut)."""
    if how == "checkpoint":
        checkpoint_root(df.sparkSession)
        return df.checkpoint(eager=True)
    if how == "persist":
        out = df.persist(StorageLevel.MEMORY_AND_DISK)
        out.count()
        return out
    return df


@dataclass
class SearchData:
    train: DataFrame
    test: DataFrame
    features: list[str]
    spec: FeatureSpec

    def release(self):
        for d in (self.train, self.test):
            if d.storageLevel != StorageLevel.NONE:
                d.unpersist()


def prepare(train_df: DataFrame, test_df: DataFrame, spec: FeatureSpec, candidates,
            replace=None, keep: str = "persist") -> SearchData:
    """Assemble ``label, features`` once for all candidates."""
    stages, feats = vector_stages(spec, candidates, replace)
    tr = with_binary_label(train_df, spec)
    te = with_binary_label(test_df, spec)
    prep = Pipeline(stages=stages).fit(tr)
    return SearchData(
        train=materialize(prep.transform(tr).select("label", "features"), keep),
        test=materialize(prep.transform(te).select("label", "features"), keep),
        features=feats, spec=spec)


def fit_eval(data: SearchData, chosen, params: ForestParams) -> float | None:
    """Holdout accuracy of a forest on a subset of the assembled features."""
    chosen = list(chosen)
    if not chosen:
        return None
    sl = slicer(data.features, chosen)
    model = params.classifier(features_col="sliced").fit(sl.transform(data.train))
    return accuracy(model.transform(sl.transform(data.test)))


def _trial(data: SearchData, chosen, params: ForestParams, ledger: TrialLedger | None) -> float | None:
    """``fit_eval``, unless the ledger has the result."""
    if ledger is None:
        return fit_eval(data, chosen, params)
    return ledger.accuracy(data, list(chosen), params, lambda: fit_eval(data, chosen, params))


def _pmap(fn, items, parallelism: int):
    items = list(items)
    if parallelism <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(fn, items))


def prefix_selection(data: SearchData, ranking, params: ForestParams = ForestParams(),
                     include_last: bool = True, parallelism: int = 1, ledger: TrialLedger | None = None):
    """Train on the first k ranked candidates, k = 1, 2, ...; keep the best
    k (strictly better than a coin toss, first best on ties).

    ``include_last=False`` stops one short of the full list, as the
    original loop did. Returns (features, accuracy, trial rows).
    """
    ranking = list(ranking)
    top = len(ranking) if include_last else len(ranking) - 1
    ks = list(range(1, top + 1))
    accs = _pmap(lambda k: _trial(data, ranking[:k], params, ledger), ks, parallelism)
    best_acc, best_k, trials = COIN_TOSS, 0, []
    for k, acc in zip(ks, accs):
        trials.append(("prefix", k, f"features={k}", acc))
        log.info("prefix of %d: accuracy %s", k, acc)
        if acc is not None and acc > best_acc:
            best_acc, best_k = acc, k
    return ranking[:best_k], best_acc, trials


def greedy_selection(data: SearchData, candidates, params: ForestParams = ForestParams(),
                     epsilon: float = 1e-4, parallelism: int = 4, ledger: TrialLedger | None = None):
    """Forward selection: each round tries every remaining candidate added
    to the chosen set; going left to right, a candidate becomes the round's
    pick if it beats the running best by more than ``epsilon``. Stops when
    a round has no pick. Returns (features, accuracy, trial rows)."""
    remaining = list(candidates)
    chosen: list[str] = []
    best_acc, trials, n = COIN_TOSS, [], 0
    while remaining:
        accs = _pmap(lambda c: _trial(data, chosen + [c], params, ledger), remaining, parallelism)
        pick = None
        for c, acc in zip(remaining, accs):
            n += 1
            trials.append(("greedy", n, f"with {c}", acc))
            if acc is not None and acc - best_acc > epsilon:
                best_acc, pick = acc, c
        if pick is None:
            break
        remaining.remove(pick)
        chosen.append(pick)
        log.info("chose %s: accuracy %s", pick, best_acc)
    order = {c: i for i, c in enumerate(data.features)}
    return sorted(chosen, key=order.get), best_acc, trials


def tune(data: SearchData, features, params: ForestParams, kind: str, low: int, high: int,
         parallelism: int = 1, ledger: TrialLedger | None = None):
    """Try ``kind`` (numTrees, maxDepth or maxBins) = low..high; keep the
    first best. Returns (best value, accuracy, trial rows, tuned params)."""
    if kind not in TUNABLE:
        raise ValueError(f"bad param type {kind!r}; one of {sorted(TUNABLE)}")
    field = TUNABLE[kind]
    values = list(range(int(low), int(high) + 1))
    accs = _pmap(lambda v: _trial(data, features, params.with_(**{field: v}), ledger),
                 values, parallelism)
    best_acc, best, trials = 0.0, int(low), []
    for i, (v, acc) in enumerate(zip(values, accs)):
        trials.append((kind, i + 1, f"{kind}={v}", acc))
        if acc is not None and acc > best_acc:
            best_acc, best = acc, v
    return best, best_acc, trials, params.with_(**{field: best})


def tune_trees(data: SearchData, features, params: ForestParams, low: int, high: int):
    """Try numTrees = low..high on one fit: the first k trees of the largest
    forest are a forest of k trees, and running votes give the holdout
    accuracy of every k in one pass. Keeps the first best. Returns (best value,
    accuracy, trial rows, tuned params), as ``tune`` does.

    Accuracy counts one vote per tree; forests fitted for each k alone would
    draw other samples from the third tree on, so single figures can differ
    from ``tune``'s.
    """
    if not 1 <= low <= high:
        raise ValueError(f"no number of trees between {low} and {high}")
    cut = slicer(data.features, list(features))
    model = params.with_(num_trees=high).classifier(features_col="sliced").fit(cut.transform(data.train))
    voted = with_votes(cut.transform(data.test), trees_of(model), "sliced")
    accs = {r["trees"]: r["accuracy"] for r in prefix_accuracy(voted).collect()}  # a row per tree
    best_acc, best, trials = 0.0, int(low), []
    for i, k in enumerate(range(int(low), int(high) + 1)):
        trials.append(("numTrees", i + 1, f"numTrees={k}", accs.get(k)))
        if accs.get(k) is not None and accs[k] > best_acc:
            best_acc, best = accs[k], k
    return best, best_acc, trials, params.with_(num_trees=best)


def report_params(spec: FeatureSpec, features, params: ForestParams) -> str:
    """Counts of features, trees and depth, as one text (M10)."""
    feats = list(features)
    n_cont = sum(1 for c in feats if spec.is_continuous(c))
    n_disc = sum(1 for c in feats if spec.is_discrete(c))
    return (f"continuous={n_cont} categorical={n_disc} "
            f"trees={params.num_trees} depth={params.max_depth}")


def trials_frame(spark: SparkSession, rows) -> DataFrame:
    """Trial table ``search, trial, params, accuracy`` (one row per fit)."""
    clean = [(s, int(t), p, None if a is None else float(a)) for s, t, p, a in rows]
    return spark.createDataFrame(clean, TRIAL_SCHEMA)


def candidates(scores: DataFrame, threshold: float, k: int | None = None) -> DataFrame:
    """``feature, rank, score``: features scoring above ``threshold`` by
    descending score (name breaks ties), first ``k`` of them.

    The score table has one row per feature, so its ranking window is
    bounded by the schema width.
    """
    from pyspark.sql import Window
    w = Window.orderBy(F.desc("score"), F.asc("feature"))
    ranked = (scores.filter(F.col("score") > F.lit(float(threshold)))
              .withColumn("rank", F.row_number().over(w).cast("int")))
    if k is not None:
        ranked = ranked.filter(F.col("rank") <= k)
    return ranked.select("feature", "rank", "score")


def best_trial(trials: DataFrame) -> DataFrame:
    """The first trial with the highest accuracy."""
    return (trials.filter(F.col("accuracy").isNotNull())
            .orderBy(F.desc("accuracy"), F.asc("trial")).limit(1))


def threshold_trials(df: DataFrame, feature: str, label_count: str = "label_count",
                     search: str | None = None) -> DataFrame:
    """Trial table of the rules "predict 1 when ``feature >= t``", one
    trial per distinct value ``t`` (ascending), with their accuracy.

    Built from grouped counts, not from a pass per rule: one aggregate by
    value, then distributed running sums over it (``checks.prefix_sums``),
    so a feature with many distinct values is not ranked in one task.
    """
    from fieldnotes.operators.checks import prefix_sums
    y, x = F.col(label_count), F.col(feature)
    g = (df.filter(y.isNotNull() & x.isNotNull())
         .groupBy(x.alias("t"))
         .agg(F.sum((y == 0).cast("long")).alias("neg"),
              F.sum((y > 0).cast("long")).alias("pos")))
    p = prefix_sums(g, ["t"], ["neg", "pos"])
    right = F.col("neg_before") + (F.col("pos_total") - F.col("pos_before"))
    return p.select(
        F.lit(search or f"stump:{feature}").alias("search"),
        (F.col("position") + 1).cast("int").alias("trial"),
        F.concat(F.lit(f"{feature}>="), F.col("t").cast("string")).alias("params"),
        (right / (F.col("neg_total") + F.col("pos_total"))).alias("accuracy"))

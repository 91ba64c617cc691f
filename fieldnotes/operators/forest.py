"""Random forest: configuration (M1), training (M3), trials (M4, M5),
scoring (M9) and holdout accuracy (A8, P14).

``spark.ml`` grows the trees; split finding, binning and level-wise
statistics are its own distributed aggregations. Note: ``spark.ml``
forests average the trees' class probabilities, where one-vote-per-tree
forests count votes -- predictions can differ on close rows.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, replace

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldnotes.operators.vectors import vector_stages, with_binary_label
from fieldnotes.spec import FeatureSpec


@dataclass(frozen=True)
class ForestParams:
    num_trees: int = 50
    max_depth: int = 10
    max_bins: int = 100
    impurity: str = "gini"
    subset_strategy: str = "auto"
    seed: int = 42
    bootstrap: bool = True

    def classifier(self, features_col: str = "features",
                   label_col: str = "label") -> RandomForestClassifier:
        return RandomForestClassifier(
            featuresCol=features_col, labelCol=label_col,
            numTrees=self.num_trees, maxDepth=self.max_depth, maxBins=self.max_bins,
            impurity=self.impurity, featureSubsetStrategy=self.subset_strategy,
            bootstrap=self.bootstrap, seed=self.seed)

    def with_(self, **kw) -> "ForestParams":
        return replace(self, **kw)

    def as_dict(self) -> dict:
        return asdict(self)


TUNABLE = {"numTrees": "num_trees", "maxDepth": "max_depth", "maxBins": "max_bins"}


def forest_pipeline(spec: FeatureSpec, features=None, params: ForestParams = ForestParams(),
                    replace=None) -> Pipeline:
    """Indexers + missing fill + assembler + forest, as one estimator."""
    stages, _ = vector_stages(spec, features, replace)
    return Pipeline(stages=stages + [params.classifier()])


def train(df: DataFrame, spec: FeatureSpec, features=None,
          params: ForestParams = ForestParams(), replace=None,
          keep: str = "persist") -> PipelineModel:
    """Fit on labelled rows (rows with a missing label are left out).

    The fit reads its input several times (indexer, split candidates,
    bagging), so the input is persisted (memory and disk) for the fit and
    released after; ``keep='none'`` when the caller keeps it already.
    """
    labelled = with_binary_label(df, spec)
    if keep == "persist":
        labelled = labelled.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        check_categories(labelled, spec, features, params)
        return forest_pipeline(spec, features, params, replace).fit(labelled)
    finally:
        if keep == "persist":
            labelled.unpersist()


def accuracy(predictions: DataFrame, label: str = "label",
             prediction: str = "prediction") -> float:
    """Share of rows with ``label == prediction``: one aggregate."""
    row = accuracy_table(predictions, [], label, prediction).first()
    return float(row["accuracy"]) if row["n"] else float("nan")


def accuracy_table(predictions: DataFrame, by: list[str], label: str = "label",
                   prediction: str = "prediction") -> DataFrame:
    """``by..., n, n_correct, accuracy`` (rows, correct ones, their share)."""
    hit = (F.col(label) == F.col(prediction)).cast("long")
    return predictions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(hit).alias("n_correct"), F.avg(hit.cast("double")).alias("accuracy"))


def trial(model: PipelineModel, test: DataFrame, spec: FeatureSpec) -> float:
    """Holdout accuracy of a fitted model (M4)."""
    return accuracy(model.transform(with_binary_label(test, spec)))


def run_trial(train_df: DataFrame, test_df: DataFrame, spec: FeatureSpec, features=None,
              params: ForestParams = ForestParams()) -> float:
    """Fit with the given configuration, then measure on the holdout (M5)."""
    return trial(train(train_df, spec, features, params), test_df, spec)


def score(model: PipelineModel, df: DataFrame, key: str,
          out: str = "prediction", keep: list[str] | None = None) -> DataFrame:
    """``key, prediction`` (int) and the columns in ``keep``: one transform,
    no shuffle (M9)."""
    return model.transform(df).select(F.col(key), F.col("prediction").cast("int").alias(out), *(keep or []))


def check_categories(df: DataFrame, spec: FeatureSpec, features, params: ForestParams) -> None:
    """Stop before the fit if a discrete feature has more names than a tree
    has bins (one more code stands for missing and unseen names)."""
    names = [c for c in (features or spec.predictors) if spec.is_discrete(c)]
    if not names:
        return
    counts = df.agg(*[F.count_distinct(c).alias(c) for c in names]).first()
    for c in names:
        if counts[c] + 1 > params.max_bins:
            raise ValueError(f"column {c!r} has {counts[c]} names; with max_bins={params.max_bins} "
                             f"a forest takes at most {params.max_bins - 1}")

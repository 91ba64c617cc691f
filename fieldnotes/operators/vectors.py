"""Feature vectors for ``spark.ml`` (V1-V6, A9).

A model input is: discrete features coded by ``StringIndexer`` (missing
and unseen names get their own extra code, and the column carries its
arity as metadata, so the forest treats it as categorical); continuous
features with missing replaced by a per-feature value (default -1: the
forest then sees three states, -1 missing, 0 absent, x > 0); the label left
out. Everything is a pipeline stage, so the saved model applies the same
dictionary and replacement when it scores.
"""

from __future__ import annotations

from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldnotes.operators import measures
from fieldnotes.operators.parse import category_cells, numeric_cells
from fieldnotes.spec import FeatureSpec

MISSING_FILL = -1.0
IDX = "__idx"
FILLED = "__in"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ordered_features(spec: FeatureSpec, features=None) -> list[str]:
    """Model inputs in file order (the vector position of each), label and
    non-feature columns removed."""
    chosen = set(features) if features is not None else set(spec.predictors)
    return [c for c in spec.columns if c in chosen and c != spec.label
            and (spec.is_continuous(c) or spec.is_discrete(c))]


def fill_stage(spec: FeatureSpec, continuous: list[str],
               replace: dict[str, float] | None = None) -> SQLTransformer:
    """Missing continuous cells -> ``replace[c]`` (default -1), as new
    columns ``<c>__in``. A SQL stage, so it is saved with the model."""
    rep = dict(spec.replace)
    rep.update(replace or {})
    cols = ", ".join(
        f"coalesce({_q(c)}, CAST({float(rep.get(c, MISSING_FILL))!r} AS DOUBLE)) AS {_q(c + FILLED)}"
        for c in continuous)
    return SQLTransformer(statement=f"SELECT *{', ' if cols else ''}{cols} FROM __THIS__")


def vector_stages(spec: FeatureSpec, features=None, replace=None,
                  output: str = "features") -> tuple[list, list[str]]:
    """Stages that build the feature vector; returns (stages, slot names)."""
    feats = ordered_features(spec, features)
    disc = [c for c in feats if spec.is_discrete(c)]
    cont = [c for c in feats if spec.is_continuous(c)]
    stages = []
    if disc:
        stages.append(StringIndexer(inputCols=disc, outputCols=[c + IDX for c in disc],
                                    stringOrderType="alphabetAsc", handleInvalid="keep"))
    stages.append(fill_stage(spec, cont, replace))
    slots = [c + IDX if spec.is_discrete(c) else c + FILLED for c in feats]
    stages.append(VectorAssembler(inputCols=slots, outputCol=output))
    return stages, feats


def slicer(all_features: list[str], chosen, input_col: str = "features",
           output: str = "sliced") -> VectorSlicer:
    """Take a subset of an assembled vector by position (V5); attribute
    metadata (categorical arity) is kept."""
    pos = {c: i for i, c in enumerate(all_features)}
    idx = sorted(pos[c] for c in chosen)
    return VectorSlicer(inputCol=input_col, outputCol=output, indices=idx)


def category_arity(df: DataFrame, col: str = "features") -> dict[int, int]:
    """Vector position -> number of categories, from column metadata (A9)."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    out = {}
    for a in meta.get("attrs", {}).get("nominal", []):
        out[int(a["idx"])] = len(a.get("vals", [])) or int(a.get("num_vals", 0))
    return out


def fill_values(wide: DataFrame, spec: FeatureSpec, features=None) -> dict[str, object]:
    """Mean of each continuous and mode of each discrete feature (V6).

    Two grouped aggregates over the long forms; the result has one value
    per feature (bounded by the schema, not the rows) and is brought to
    the driver to become literals of ``na.fill``.
    """
    feats = ordered_features(spec, features) if features is not None else \
        [c for c in spec.columns if spec.is_continuous(c) or spec.is_discrete(c)]
    cont = [c for c in feats if spec.is_continuous(c)]
    disc = [c for c in feats if spec.is_discrete(c)]
    out: dict[str, object] = {}
    if cont:
        m = measures.feature_means(numeric_cells(wide, spec, features=cont, with_label=False))
        out.update({r["feature"]: r["mean"] for r in m.collect() if r["mean"] is not None})
    if disc:
        m = measures.feature_modes(category_cells(wide, features=disc))
        out.update({r["feature"]: r["mode"] for r in m.collect()})
    return out


def fill_missing(wide: DataFrame, spec: FeatureSpec, features=None,
                 values: dict[str, object] | None = None) -> DataFrame:
    """Replace missing cells by the given values, or by mean / mode."""
    vals = values if values is not None else fill_values(wide, spec, features)
    nums = {k: float(v) for k, v in vals.items() if not isinstance(v, str)}
    texts = {k: v for k, v in vals.items() if isinstance(v, str)}
    out = wide
    if nums:
        out = out.na.fill(nums)
    if texts:
        out = out.na.fill(texts)
    return out


def with_binary_label(df: DataFrame, spec: FeatureSpec, out: str = "label") -> DataFrame:
    """Rows with a label, plus ``label`` = 1.0 if the count > 0 else 0.0."""
    y = F.col(spec.label)
    return df.filter(y.isNotNull()).withColumn(out, (y > 0).cast("double"))

"""Rank features by their measures (the library path: means, Pearson
scores of continuous features, chi-squared scores of discrete ones, modes).

    spark-submit -m fieldnotes.jobs.rank --input labeled.csv.bz2 --output scores/
        [--spec spec.json] [--pairwise] [--partitions 60]

Plan: scan -> parse -> staged once as parquet in the shared folder (the
measures read it in column slices) -> one partial-aggregated pass per
measure family -> table ``measure, feature, score, rank`` (rank by
descending score, name as tie-break; means and modes are not ranked).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldnotes.jobs.train import load_spec
from fieldnotes.operators import measures
from fieldnotes.operators.parse import (category_cells, numeric_cells, numeric_features,
                                        parse, sparse_cells)
from fieldnotes.session import get_spark, staged
from fieldnotes.sources.csv import read_observations
from fieldnotes.spec import FeatureSpec


def feature_ranking(wide: DataFrame, spec: FeatureSpec, pairwise: bool = False,
                    features=None) -> DataFrame:
    """``measure, feature, score, rank`` for every column of the spec that can
    be a feature, or for those of ``features``. The spec's own chosen set
    doesn't matter: ranking is what it is chosen from."""
    label = spec.label
    chosen = set(features or ())
    feats = [c for c in numeric_features(spec) if not chosen or c in chosen or c == label]
    names = [c for c in spec.discrete_features if not chosen or c in chosen]
    measured = measures.sparse_measures(sparse_cells(wide, spec, features=feats), feats, label)
    if pairwise:
        scores = measures.pearson_scores(numeric_cells(wide, spec, features=feats), label,
                                         pairwise=True, features=feats)
    else:
        scores = measured.filter(F.col("feature") != label)
    # means and Pearson scores come from one aggregate, unpivoted
    parts = [measured.select(F.lit("mean").alias("measure"), "feature", F.col("mean").alias("score")),
             scores.select(F.lit("pearson").alias("measure"), "feature", "score")]
    if names:
        cat = category_cells(wide, spec, features=names)
        parts.append(measures.chi_squared_scores(cat).select(
            F.lit("chi_squared").alias("measure"), "feature", "score"))
        parts.append(measures.feature_modes(cat).select(
            F.lit("mode").alias("measure"), "feature",
            F.col("mode_count").cast("double").alias("score")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # one row per feature and measure: the ranking window is bounded by
    # the schema width
    w = Window.partitionBy("measure").orderBy(F.desc_nulls_last("score"), "feature")
    ranked = F.when(F.col("measure").isin("pearson", "chi_squared"),
                    F.row_number().over(w))
    return out.withColumn("rank", ranked.cast("int"))


def main(argv=None):
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--spec", default=None)
    p.add_argument("--features", default=None)
    p.add_argument("--pairwise", action="store_true")
    p.add_argument("--partitions", type=int, default=None)
    p.add_argument("--master", default=None)
    p.add_argument("--scratch", default=None, help="shared folder, where spark.checkpoint.dir is unset")
    args = p.parse_args(argv)
    spark = get_spark("rank", master=args.master, shuffle_partitions=args.partitions,
                      scratch=args.scratch)
    spec = load_spec(spark, args)
    wide = parse(read_observations(spark, args.input, spec, args.partitions), spec)
    with staged(wide, "rank-input") as table:
        feature_ranking(table, spec, args.pairwise, spec.features if args.features else None).write.mode("overwrite").parquet(args.output)
    return 0


if __name__ == "__main__":
    sys.exit(main())

"""Train job (S10): labelled file -> model folder.

    spark-submit -m fieldnotes.jobs.train --input labeled.csv.bz2 --output out/
        [--spec spec.json] [--partitions 60] [--num-trees 50 --max-depth 10
        --max-bins 100] [--seed 42] [--features A,B,...] [--keep persist]

Plan: one scan (only needed columns are decoded) -> parse -> split 70/30 ->
staged in the shared folder for the time of the job -> one grouped count of
the classes -> undersample each part -> fit pipeline -> holdout accuracy,
on the balanced and on the natural holdout -> save pipeline, feature set,
replacement map, dictionary, spec and report.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from fieldnotes.operators import balance, forest, search
from fieldnotes.operators.parse import parse
from fieldnotes.session import get_spark, staged
from fieldnotes.sources import model_store
from fieldnotes.sources.csv import read_header, read_observations
from fieldnotes.spec import FeatureSpec, checklist_spec, spec_for_header


PART = "__part"


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--spec", help="FeatureSpec JSON file (default: checklist layout)")
    p.add_argument("--partitions", type=int, default=None)
    p.add_argument("--num-trees", type=int, default=50)
    p.add_argument("--max-depth", type=int, default=10)
    p.add_argument("--max-bins", type=int, default=100)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--features", default=None, help="comma-separated model inputs")
    p.add_argument("--method", choices=("hash", "random"), default="hash")
    p.add_argument("--keep", choices=("persist", "checkpoint", "none"), default="persist")
    p.add_argument("--master", default=None)
    p.add_argument("--scratch", default=None, help="shared folder, where spark.checkpoint.dir is unset")
    return p


def load_spec(spark, args) -> FeatureSpec:
    header = read_header(spark, args.input)
    if args.spec:  # read like any input, so it may lie in the shared store
        text = "\n".join(r[0] for r in spark.read.text(args.spec).collect())
        spec = spec_for_header(FeatureSpec.from_json(text), header)
    else:
        spec = checklist_spec(header)
    if args.features:
        spec = spec.with_features([c.strip() for c in args.features.split(",") if c.strip()])
    return spec


def run(spark, args) -> dict:
    spec = load_spec(spark, args)
    features = list(spec.predictors)
    key = spec.key
    # only the key, the label and the model's inputs are parsed, split and
    # kept (the scan then decodes just these columns)
    needed = [c for c in dict.fromkeys([key, spec.label, *features]) if c is not None]
    wide = parse(read_observations(spark, args.input, spec, args.partitions),
                 spec).select(*needed)
    if args.method == "hash" and key is None:
        raise SystemExit("hash split needs a key column in the spec (or use --method random)")
    if args.method == "hash":
        tagged = balance.hash_split(wide, key, salt=f"split{args.seed}", part_col=PART)
    else:
        tagged = wide.withColumn(PART, F.when(F.rand(args.seed) < 0.7, "train").otherwise("holdout"))
    with staged(tagged, "train-input") as rows:  # the raw file is read once
        return _fit(spark, args, spec, features, rows)


def _fit(spark, args, spec: FeatureSpec, features: list[str], rows) -> dict:
    key = spec.key
    sizes = balance.part_sizes(rows, PART, spec.label)
    part = lambda name: rows.filter(F.col(PART) == name).drop(PART)
    sample_salt = f"sample{args.seed}"
    balanced = lambda name: search.materialize(
        balance.undersample(part(name), key, spec.label, args.method, args.seed, sample_salt,
                            sizes.get(name, (0.0, 0.0))), args.keep)
    train, test, test_part = balanced("train"), balanced("holdout"), part("holdout")
    params = forest.ForestParams(num_trees=args.num_trees, max_depth=args.max_depth,
                                 max_bins=args.max_bins, seed=args.seed)
    model = forest.train(train, spec, features, params,
                         keep="none" if args.keep != "none" else "persist")
    acc = forest.trial(model, test, spec)
    acc_natural = forest.trial(model, test_part, spec)
    text = search.report_params(spec, features, params)
    report = search.trials_frame(spark, [("final", 0, text, acc),
                                         ("final:natural", 1, text, acc_natural)])
    model_store.save(spark, args.output, model, spec, features, report)
    return {"accuracy": acc, "accuracy_natural": acc_natural, "features": features}


def main(argv=None):
    args = build_parser().parse_args(argv)
    spark = get_spark("train", master=args.master, shuffle_partitions=args.partitions,
                      scratch=args.scratch)
    result = run(spark, args)
    print(f"Final model accuracy: {result['accuracy']}")
    print(json.dumps(result))
    return 0


if __name__ == "__main__":
    sys.exit(main())

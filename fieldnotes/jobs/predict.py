"""Predict job (S11): unlabeled file + model folder -> predictions.

    spark-submit -m fieldnotes.jobs.predict --input unlabeled.csv.bz2
        --output predictions/ --model out/ [--partitions 60] [--single-file]

One scan and one transform: the dictionary, the missing-value fill and the
forest are stages of the saved pipeline. Output rows keep input order, over
several files too (by name): ``id, prediction`` is sorted by place in the
input. ``--partitions`` sets the shuffle's, so it never moves rows.
"""

from __future__ import annotations

import argparse
import sys

from fieldnotes.operators import forest
from fieldnotes.operators.checks import FILE_ORDER
from fieldnotes.operators.parse import parse
from fieldnotes.session import get_spark
from fieldnotes.sources import model_store, sink
from fieldnotes.sources.csv import read_header, read_observations
from fieldnotes.spec import spec_for_header


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--model", required=True)
    p.add_argument("--partitions", type=int, default=None)
    p.add_argument("--single-file", action="store_true")
    p.add_argument("--master", default=None)
    p.add_argument("--scratch", default=None, help="shared folder, where spark.checkpoint.dir is unset")
    return p


def run(spark, args):
    stored = model_store.load(spark, args.model)
    spec = spec_for_header(stored.spec, read_header(spark, args.input))
    if spec.key is None:
        raise SystemExit(f"input has no key column {stored.spec.key!r}")
    raw = read_observations(spark, args.input, spec, ordered=True)
    preds = forest.score(stored.pipeline, parse(raw, spec, keep=FILE_ORDER), spec.key, keep=FILE_ORDER)
    sink.write_predictions(preds, args.output, spec.key, single_file=args.single_file)


def main(argv=None):
    args = build_parser().parse_args(argv)
    spark = get_spark("predict", master=args.master, shuffle_partitions=args.partitions,
                      scratch=args.scratch)
    run(spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())

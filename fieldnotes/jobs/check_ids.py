"""Check that a prediction file lists the input ids in input order (R12).

    spark-submit -m fieldnotes.jobs.check_ids --input in.csv.bz2
        --output predictions/ [--id-column NAME]

Prints the metrics of ``checks.id_order_check`` and exits 1 on any
mismatch. Positions follow file names, then the lines of each file, on both
sides.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from fieldnotes.operators.checks import compare_positions, file_positions
from fieldnotes.session import get_spark
from fieldnotes.sources.csv import read_header


def _ids(spark, path: str, column: str | None):
    names = read_header(spark, path)
    schema = ", ".join(f"`{c}` string" for c in names)
    df = spark.read.option("header", True).option("quote", "").schema(schema).csv(path)
    return df.select(F.col(column or names[0]).alias("id"))


def main(argv=None):
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--id-column", default=None, help="default: first column of the input")
    p.add_argument("--master", default=None)
    p.add_argument("--scratch", default=None, help="shared folder, where spark.checkpoint.dir is unset")
    args = p.parse_args(argv)
    spark = get_spark("check_ids", master=args.master, scratch=args.scratch)
    result = compare_positions(
        file_positions(_ids(spark, args.input, args.id_column)).withColumnRenamed("id", "in_id"),
        file_positions(_ids(spark, args.output, None)).withColumnRenamed("id", "out_id"))
    metrics = {r["metric"]: r["n"] for r in result.collect()}
    for k in ("n_input", "n_output", "n_mismatch", "n_missing", "n_extra"):
        print(f"{k}={metrics.get(k)}")
    ok = metrics.get("n_mismatch") == 0
    print("Sample ids match." if ok else "Sample ids do not match.")
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main())

"""Sample a delimited file (R11): keep the header and each record with
probability ``rate``; report processed and sampled counts.

    spark-submit -m fieldnotes.jobs.sample --input in.csv.bz2 --output out/
        [--rate 0.01] [--seed 17] [--key SAMPLING_EVENT_ID]
"""

from __future__ import annotations

import argparse
import sys

from fieldnotes.session import get_spark
from fieldnotes.sources.csv import sample_file


def main(argv=None):
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--rate", type=float, default=0.01)
    p.add_argument("--seed", type=int, default=17)
    p.add_argument("--key", default=None, help="hash this column for a repeatable draw")
    p.add_argument("--compression", default="bzip2")
    p.add_argument("--master", default=None)
    p.add_argument("--scratch", default=None, help="shared folder, where spark.checkpoint.dir is unset")
    args = p.parse_args(argv)
    spark = get_spark("sample", master=args.master, scratch=args.scratch)
    counts = sample_file(spark, args.input, args.output, args.key, args.rate, args.seed,
                         compression=args.compression)
    print(f"Sampled {counts['sampled']} of {counts['processed']} records.")
    return 0


if __name__ == "__main__":
    sys.exit(main())

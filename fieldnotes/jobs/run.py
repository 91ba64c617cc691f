"""One entry point chosen by argument count (S12), as the original job:

    spark-submit -m fieldnotes.jobs.run MASTER PARALLELISM INPUT OUTPUT         # train
    spark-submit -m fieldnotes.jobs.run MASTER PARALLELISM INPUT OUTPUT MODEL   # predict

MASTER is passed to the session unless it is ``-`` (leave it to
spark-submit); PARALLELISM sets shuffle partitions and default parallelism.
The spec is the checklist layout read from the input header.
"""

from __future__ import annotations

import sys

from fieldnotes.jobs import predict, train


def main(argv=None):
    args = list(sys.argv[1:] if argv is None else argv)
    if len(args) not in (4, 5):
        print(__doc__, file=sys.stderr)
        return 2
    master, parallelism, inp, out = args[:4]
    common = ["--partitions", parallelism, "--input", inp, "--output", out]
    if master != "-":
        common += ["--master", master]
    if len(args) == 4:
        return train.main(common)
    return predict.main(common + ["--model", args[4]])


if __name__ == "__main__":
    sys.exit(main())

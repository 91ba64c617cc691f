"""Delimited observation files: scan (S1) and file sampling (R11)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fieldnotes.functions.hashing import uniform
from fieldnotes.operators.checks import file_order
from fieldnotes.spec import FeatureSpec

WHOLE_FILE = 1 << 50  # bytes: no file is split, and none shares a task


def read_header(spark: SparkSession, path: str | list[str], sep: str = ",") -> list[str]:
    """Column names from the first line of the first file by name."""
    for name in sorted(spark.read.text(path).inputFiles()):
        first = spark.read.text(name).limit(1).collect()
        if first:
            return first[0][0].split(sep)
    raise ValueError(f"{path}: empty input")


def read_observations(spark: SparkSession, path: str | list[str], spec: FeatureSpec,
                      partitions: int | None = None, sep: str = ",",
                      quoting: bool = False, keep_empty: bool = False,
                      ordered: bool = False) -> DataFrame:
    """Read a delimited file (plain or .bz2; one header per file) as text.

    The schema comes from the spec, so nothing is inferred and only the
    columns a later ``select`` uses are parsed by the CSV reader (column
    pruning). ``quoting=False`` splits on every separator, as a plain
    ``split`` would; short rows get NULL for their absent tail.
    ``partitions`` repartitions the scan (round robin) when the input is a
    few unsplittable files; rows then lose their order. ``ordered=True`` adds
    the columns of ``checks.file_order`` instead. Every file must have the
    first one's header: columns are read by place.

    ``keep_empty=True`` keeps an empty cell inside a row as empty text
    (the CSV reader makes it NULL, like an absent cell): lines are read as
    text and split on the separator; trailing empty cells count as absent. A
    line equal to the first one is a header, so files may come without one
    (as the parts of ``sample_file`` do).
    """
    if not keep_empty:
        check_headers(spark, path, sep)
    if keep_empty:
        df = _read_split_lines(spark, path, spec, sep)
    else:
        reader = (spark.read.schema(spec.raw_schema())
                  .option("header", True)
                  .option("sep", sep)
                  .option("mode", "PERMISSIVE")
                  .option("enforceSchema", True))
        if not quoting:
            reader = reader.option("quote", "")
        df = reader.csv(path)
    if ordered:
        return file_order(df)
    if partitions:
        df = df.repartition(partitions)
    return df


def first_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, line``: the first line of every file that has one, in one job.

    The files are planned unsplit, one task each, and a task stops at its
    first line, so no more than a read buffer of each file is read.
    """
    own = spark.newSession()  # the settings are for this scan alone
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        own.conf.set(name, str(WHOLE_FILE))
    own.conf.set("spark.sql.files.maxPartitionNum", str((1 << 31) - 1))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")

    def first(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    return (own.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
            .mapInArrow(first, "file string, line string"))


def check_headers(spark: SparkSession, path: str | list[str], sep: str = ",") -> None:
    """Stop if files of one input name their columns differently. Equal
    headers are counted together, so two rows reach the driver."""
    headers = (first_lines(spark, path).groupBy("line").agg(F.min("file").alias("file"))
               .orderBy("file").limit(2).collect())
    if len(headers) > 1:
        raise ValueError(f"files with different headers: {headers[0]['file']} and {headers[1]['file']}")


def _read_split_lines(spark: SparkSession, path, spec: FeatureSpec, sep: str) -> DataFrame:
    header = read_header(spark, path, sep)
    head_text = sep.join(header)
    lines = spark.read.text(path).filter(F.col("value") != F.lit(head_text))
    trimmed = F.regexp_replace("value", f"({re.escape(sep)})+$", "")
    cells = F.split(trimmed, re.escape(sep), -1)
    return lines.select(*[F.try_element_at(cells, F.lit(i + 1)).alias(c)
                          for i, c in enumerate(spec.columns)])


def sample_file(spark: SparkSession, path: str, out: str, key: str | None = None,
                rate: float = 0.01, seed: int = 17, sep: str = ",",
                compression: str = "bzip2") -> dict[str, int]:
    """Keep each record, as it is, with probability ``rate``; write one header
    line (in the first part file) and the records kept.

    Lines are copied as text, no cell is parsed but the key's. With ``key``
    the draw is the repeatable hash of the key, otherwise Spark's seeded
    per-partition sampler. Counts of processed and sampled records come from
    one pass, by ``Observation`` metrics on the write.
    """
    # Observation metrics run in a child session (same context): once a
    # session has observed metrics, forests fitted in it capture a
    # non-serializable observation manager and cannot score.
    spark = spark.newSession()
    header = read_header(spark, path, sep)
    head = sep.join(header)
    df = spark.read.text(path).where(F.col("value") != F.lit(head))
    seen = Observation("processed")
    df = df.observe(seen, F.count(F.lit(1)).alias("processed"))
    if key:
        cell = F.try_element_at(F.split("value", re.escape(sep), -1), F.lit(header.index(key) + 1))
        kept = df.filter(uniform(cell, salt=str(seed)) < F.lit(rate))
    else:
        kept = df.sample(withReplacement=False, fraction=rate, seed=seed)
    taken = Observation("sampled")
    kept = kept.observe(taken, F.count(F.lit(1)).alias("sampled"))
    first = spark.createDataFrame([(head,)], "value string").coalesce(1)
    # one header over all part files, as the file that they make up in order
    first.union(kept).write.mode("overwrite").option("compression", compression).text(out)
    return {"processed": int(seen.get["processed"]), "sampled": int(taken.get["sampled"])}

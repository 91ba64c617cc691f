"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldnotes.session import checkpoint_root

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package when it is used from a
    checkout (an installed package or --py-files needs nothing)."""
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if _ROOT not in have.split(":"):
        env["PYTHONPATH"] = f"{_ROOT}:{have}" if have else _ROOT


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares."""
    return f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write as Parquet in the shared folder and read it back: the lineage
    is cut, and lost executors cost only the tasks that were running."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(*frames: DataFrame) -> None:
    """Delete the files of staged frames that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            at = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
            at.getFileSystem(conf).delete(at, True)


#: Rows of a few numbers that are sent to every executor: at most about 50 MB.
MOST_SENT = 500_000


def small_side(staged: DataFrame) -> DataFrame:
    """A staged narrow table as the side of a join: counted, and broadcast up
    to ``MOST_SENT`` rows, so that the wide side stays where it lies. Beyond
    that, the join shuffles both sides."""
    return F.broadcast(staged) if staged.count() <= MOST_SENT else staged


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def key_crc(column: str = "doc_id") -> Column:
    """crc32 of a key's decimal text; NULL keys count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def key_hash60(column: str = "doc_id") -> Column:
    """First 60 bits of the MD5 of a key's text, as a non-negative long;
    the same on every run, and in any engine that has MD5."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def map_batches(df: DataFrame, fn: Callable[[dict], dict], schema: str,
                make: Callable[[], object] | None = None) -> DataFrame:
    """mapInArrow with plain Python lists: ``fn`` gets a dict of column
    lists and returns a dict of column lists. ``make`` builds per-task state
    that is passed as the second argument."""
    out = pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = make() if make else None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = batch.to_pydict()
            got = fn(cols, state) if make else fn(cols)
            yield pa.RecordBatch.from_pydict(got, schema=out)

    return df.mapInArrow(run, schema)


def pa_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(ddl))


BATCH_BYTES = 16 << 20


def small_batches(spark: SparkSession, rows: int) -> None:
    """Rows and bytes in an Arrow batch: whole documents can be long, so
    batches are kept short to bound a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

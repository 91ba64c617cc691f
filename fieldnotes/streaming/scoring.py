"""The predict job's scoring over a folder of arriving files.

The operator is the same as ``jobs.predict`` (parse -> saved pipeline ->
``id, prediction``), run by Structured Streaming: each new file is scored
once; the file sink and the checkpoint make the output exactly-once across
restarts and lost executors. The checkpoint folder belongs to one output and
has to be named: a fresh one would count batches anew, and the sink would skip
them as done. Each file's header is checked against the stored columns.
Stateless -- no watermark or state store is involved.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from fieldnotes.operators import forest
from fieldnotes.operators.parse import parse
from fieldnotes.sources import model_store
from fieldnotes.sources.sink import ID_HEADER, PREDICTION_HEADER
from pyspark.sql import functions as F


def score_stream(spark: SparkSession, input_dir: str, output_dir: str, model_dir: str,
                 checkpoint: str, available_now: bool = True,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start scoring CSV files (same layout as training) in ``input_dir``."""
    stored = model_store.load(spark, model_dir)
    spec = stored.spec
    reader = (spark.readStream.schema(spec.raw_schema())
              .option("header", True).option("quote", "").option("enforceSchema", False))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    wide = parse(reader.csv(input_dir), spec)
    preds = forest.score(stored.pipeline, wide, spec.key).select(
        F.col(spec.key).alias(ID_HEADER),
        F.col("prediction").alias(PREDICTION_HEADER))
    writer = (preds.writeStream.format("csv").option("header", True)
              .option("path", output_dir)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()

"""Prediction file (S9): header, then ``id,prediction`` per row.

Rows keep input order: the scan tags each row with file, split and place
(``checks.file_order``), the two narrow columns are staged, and a range sort
by the tags writes part files that follow the input. ``single_file`` has one
task write the sorted rows -- only for small outputs; scan, parse and scoring
have run in parallel before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldnotes.operators.checks import FILE_ORDER
from fieldnotes.session import staged

# Header of the prediction file.
ID_HEADER = "SAMPLING_EVENT_ID"
PREDICTION_HEADER = "SAW_AGELAIUS_PHOENICEUS"


def write_predictions(preds: DataFrame, out: str, key: str, prediction: str = "prediction",
                      id_header: str = ID_HEADER, prediction_header: str = PREDICTION_HEADER,
                      single_file: bool = False, order: list[str] | None = None) -> None:
    """``order``: columns of ``preds`` to write by (default: those of
    ``file_order`` where ``preds`` has them, else as the rows come)."""
    order = order or [c for c in FILE_ORDER if c in preds.columns]
    df = preds.select(F.col(key).alias(id_header),
                      F.col(prediction).cast("int").alias(prediction_header), *order)
    with staged(df, "predictions") as rows:
        if order:
            rows = rows.orderBy(*order).drop(*order)
        if single_file:
            rows = rows.coalesce(1)
        rows.write.mode("overwrite").option("header", True).option("quote", "").csv(out)


def read_predictions(spark: SparkSession, path: str, id_header: str = ID_HEADER,
                     prediction_header: str = PREDICTION_HEADER) -> DataFrame:
    return (spark.read.option("header", True)
            .schema(f"`{id_header}` string, `{prediction_header}` int").csv(path))

"""Observation tables derived from the test tables.

The driver's tables hold no missing or null tokens, so the derivation
plants them (the rule is fixed in FIXTURES.md). ``obs_raw`` is the text
table a delimited file would give; ``parse`` of it with ``OBS_SPEC`` is the
typed ``obs``. Built with DataFrame code only; the oracle SQL builds the
same table independently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldnotes.operators.parse import parse
from fieldnotes.spec import FeatureSpec

OBS_SPEC = FeatureSpec(
    columns=("event_id", "sampling_id", "f_day", "f_hour", "f_effort", "f_kind", "label_count"),
    label="label_count",
    key="sampling_id",
    carry=("event_id",),
    id_cols=("sampling_id",),
    discrete=("f_kind",),
)

# documents with a quality label: continuous length, discrete language and
# source (the label is a 0/1 count)
DOCS_SPEC = FeatureSpec(
    columns=("doc_id", "doc_key", "n_chars", "lang", "source", "quality"),
    label="quality",
    key="doc_key",
    carry=("doc_id",),
    discrete=("lang", "source"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def obs_raw(events: DataFrame) -> DataFrame:
    """Text observation rows from ``events`` with planted tokens."""
    eid = F.col("event_id")
    uid = F.col("user_id")
    txt = lambda c: c.cast("string")
    return events.select(
        eid.alias("event_id"),
        F.concat(F.lit("S"), txt(eid)).alias("sampling_id"),
        txt(F.dayofmonth("ts")).alias("f_day"),
        txt(F.hour("ts")).alias("f_hour"),
        F.when(eid % 11 == 0, "?").when(eid % 13 == 0, "X").when(eid % 5 == 0, "0")
        .otherwise(txt(F.col("value"))).alias("f_effort"),
        F.when(eid % 19 == 0, "?").otherwise(F.col("event_type")).alias("f_kind"),
        F.when(eid % 17 == 0, "?").when(uid % 10 == 3, "X")
        .when(uid % 3 == 0, txt(eid % 7 + 1)).otherwise("0").alias("label_count"),
    )


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed observation table (wide form)."""
    return parse(obs_raw(table(spark, sf_dir, "events")), OBS_SPEC)


def docs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as text rows: length, language, source, quality.

    ``labels`` covers some documents; the join is on the document key, and
    AQE picks broadcast or shuffled join from the measured label table.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id", "inner").select(
        "doc_id",
        F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("doc_key"),
        F.col("n_chars").cast("string").alias("n_chars"),
        "lang", "source",
        F.col("quality").cast("string").alias("quality"))


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(docs_raw(spark, sf_dir), DOCS_SPEC)


# The same table in SQL text, for oracles (runs in DuckDB and Spark SQL).
OBS_CTE = """WITH obs_raw AS (
  SELECT event_id,
    concat('S', cast(event_id AS varchar(20))) AS sampling_id,
    cast(extract(day FROM ts) AS varchar(20)) AS f_day,
    cast(extract(hour FROM ts) AS varchar(20)) AS f_hour,
    CASE WHEN event_id % 11 = 0 THEN '?' WHEN event_id % 13 = 0 THEN 'X'
         WHEN event_id % 5 = 0 THEN '0' ELSE cast(value AS varchar(40)) END AS f_effort,
    CASE WHEN event_id % 19 = 0 THEN '?' ELSE event_type END AS f_kind,
    CASE WHEN event_id % 17 = 0 THEN '?' WHEN user_id % 10 = 3 THEN 'X'
         WHEN user_id % 3 = 0 THEN cast(event_id % 7 + 1 AS varchar(20))
         ELSE '0' END AS label_raw
  FROM events),
obs AS (
  SELECT event_id, sampling_id,
    CASE f_day WHEN '?' THEN NULL WHEN 'X' THEN 0.0e0 ELSE cast(f_day AS double) END AS f_day,
    CASE f_hour WHEN '?' THEN NULL WHEN 'X' THEN 0.0e0 ELSE cast(f_hour AS double) END AS f_hour,
    CASE f_effort WHEN '?' THEN NULL WHEN 'X' THEN 0.0e0 ELSE cast(f_effort AS double) END AS f_effort,
    nullif(f_kind, '?') AS f_kind,
    CASE label_raw WHEN '?' THEN NULL WHEN 'X' THEN 0.0e0 ELSE cast(label_raw AS double) END AS label_count
  FROM obs_raw)
"""

"""Model folder: pipeline (S2, S3), feature set (S4, S5), replacement map
(S6, S7), category dictionary (S8), spec and trial report.

Everything is written by executors as parquet / Spark ML format, typed, so
what is read back is what was saved. The dictionary is also a stage of the
pipeline, so scoring never rebuilds it from the data being scored.

A save writes a new version below the model folder, and last a manifest that
lists its files with their lengths and checksums. A version without a manifest
is never read, so a save that fails half-way leaves the model before it in
place. ``load`` takes the newest version and checks its files against the
manifest; the version before is kept, older ones are deleted.
"""

from __future__ import annotations

import re
import time
import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldnotes.operators.vectors import IDX
from fieldnotes.spec import FeatureSpec


# the terms that vectors.fill_stage writes
_FILL = re.compile(r"coalesce\(`((?:[^`]|``)+)`, CAST\(([^ ]+) AS DOUBLE\)\)")


@dataclass
class StoredModel:
    pipeline: PipelineModel
    spec: FeatureSpec
    features: list[str]
    replace: dict[str, float]


def dictionary_of(model: PipelineModel) -> list[tuple[str, str, int]]:
    """``(feature, category, code)`` from the fitted indexer stage."""
    rows = []
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            for col, labels in zip(stage.getInputCols(), stage.labelsArray):
                rows.extend((col, lab, i) for i, lab in enumerate(labels))
    return rows


def replacement_of(model: PipelineModel) -> dict[str, float]:
    """Feature -> fill value, from the fitted fill stage."""
    for stage in model.stages:
        if isinstance(stage, SQLTransformer):
            return {name.replace("``", "`"): float(value) for name, value in _FILL.findall(stage.getStatement())}
    return {}


KEPT_VERSIONS = 2
MANIFEST = "file string, length bigint, sha256 string"


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _files(spark: SparkSession, version: str) -> DataFrame:
    """``file, length, sha256`` of every file of a version, read in parallel."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(version)
            .select(F.substring_index("path", f"{version.rsplit('/', 1)[-1]}/", -1).alias("file"),
                    "length", F.sha2("content", 256).alias("sha256")))


def versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the complete versions, oldest first."""
    at, fs = _fs(spark, f"{path}/manifest")
    if not fs.exists(at):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(at)]
    return sorted(n for n in names if not n.startswith((".", "_")))


def current(spark: SparkSession, path: str) -> str:
    """Folder of the newest complete version."""
    have = versions(spark, path)
    if not have:
        raise FileNotFoundError(f"{path}: no complete model")
    return f"{path}/{have[-1]}"


def save(spark: SparkSession, out: str, model: PipelineModel, spec: FeatureSpec,
         features: list[str], report: DataFrame | None = None):
    before = versions(spark, out)
    # names follow the time, and the version before even if a clock was set back
    number = max(time.time_ns(), int(before[-1].split("-")[1]) + 1 if before else 0)
    name = f"v-{number:020d}-{uuid.uuid4().hex[:8]}"
    at = f"{out}/{name}"
    model.write().save(f"{at}/pipeline")
    spark.createDataFrame([(f, i) for i, f in enumerate(features)],
                          "feature string, position int").write.parquet(f"{at}/features")
    used = replacement_of(model)
    rep = [(f, used[f]) for f in features if f in used]
    spark.createDataFrame(rep, "feature string, value double").write.parquet(f"{at}/replace")
    spark.createDataFrame(dictionary_of(model), "feature string, category string, code int") \
        .write.parquet(f"{at}/categories")
    spark.createDataFrame([(spec.to_json(),)], T.StructType([T.StructField("value", T.StringType())])) \
        .coalesce(1).write.text(f"{at}/spec")
    if report is not None:
        report.write.parquet(f"{at}/report")
    _publish(spark, out, name)
    for old in (before + [name])[:-KEPT_VERSIONS]:
        for gone in (f"{out}/manifest/{old}", f"{out}/{old}"):
            where, fs = _fs(spark, gone)
            fs.delete(where, True)


def _publish(spark: SparkSession, out: str, name: str) -> None:
    """Write the manifest beside its place, then rename it there."""
    _files(spark, f"{out}/{name}").coalesce(1).write.parquet(f"{out}/manifest/_{name}")
    new, fs = _fs(spark, f"{out}/manifest/_{name}")
    if not fs.rename(new, _fs(spark, f"{out}/manifest/{name}")[0]):
        raise OSError(f"{out}: can't publish {name}")


def check(spark: SparkSession, path: str) -> None:
    """Stop if a file of the newest version is missing, new or changed."""
    version = current(spark, path)
    listed = spark.read.schema(MANIFEST).parquet(f"{path}/manifest/{version.rsplit('/', 1)[-1]}")
    found = _files(spark, version)
    odd = sorted({r["file"] for df in (listed.exceptAll(found), found.exceptAll(listed)) for r in df.limit(3).collect()})
    if odd:
        raise ValueError(f"{version}: files differ from the manifest: {', '.join(odd)}")


def load(spark: SparkSession, path: str) -> StoredModel:
    check(spark, path)
    path = current(spark, path)
    pipeline = PipelineModel.load(f"{path}/pipeline")
    spec = FeatureSpec.from_json(spark.read.text(f"{path}/spec").first()[0])
    feats = [r["feature"] for r in
             spark.read.parquet(f"{path}/features").orderBy("position").collect()]
    rep = {r["feature"]: r["value"] for r in spark.read.parquet(f"{path}/replace").collect()}
    return StoredModel(pipeline, spec, feats, rep)


def load_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{current(spark, path)}/categories")


__all__ = ["StoredModel", "save", "load", "check", "current", "versions", "load_dictionary", "dictionary_of", "IDX"]

"""Trial ledger of resumable searches (M6, M7, M8, M11).

A search that is stopped and started again should fit only what is missing.
Every finished trial is appended to a folder as a small Parquet file of its own
(``<key>/``), committed by Spark's file committer, so trials that run
at the same time don't disturb each other and one that was cut off leaves
nothing that is read. The key is a SHA-256 of what decides the result: the
forest's configuration with its seed, the chosen features, and a fingerprint of
the assembled train and holdout rows.

Defined results: a trial without a result (NULL accuracy) is kept as such and
not fitted again; of two entries of one key (two searches at once) the lower
accuracy is read; an empty or absent folder is an empty
ledger. Rows in another order have the same fingerprint; their forests can
differ, as bootstrapping follows the order.
"""

from __future__ import annotations

import hashlib
import json
import threading
import uuid
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "key string, params string, features string, accuracy double"


def fingerprint(df: DataFrame) -> str:
    """Row count and sum of row hashes: one pass, in any order."""
    got = df.select(F.xxhash64(*df.columns).cast("decimal(38,0)").alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("h").alias("h")).first()
    return f"{got['n']}:{got['h']}"


class TrialLedger:
    """Trials done before, by key; ``fitted`` counts those added here."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.fitted = 0
        self._lock = threading.Lock()
        self._data: dict[int, tuple[object, str]] = {}
        self._done = self._read()

    def _read(self) -> dict[str, float | None]:
        rows = self.frame().groupBy("key").agg(F.min("accuracy").alias("accuracy")).collect()  # a row per trial
        return {r["key"]: r["accuracy"] for r in rows}

    def frame(self) -> DataFrame:
        """All entries, ``key, params, features, accuracy``."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(self.path)

    def _print_of(self, data) -> str:
        with self._lock:
            known = self._data.get(id(data))
            if known is None or known[0] is not data:
                text = "|".join([fingerprint(data.train), fingerprint(data.test), ",".join(data.features)])
                known = self._data[id(data)] = (data, text)
            return known[1]

    def accuracy(self, data, chosen: list[str], params, fit) -> float | None:
        """The trial's accuracy: from the ledger, or of ``fit()``, then kept."""
        config = json.dumps(asdict(params), sort_keys=True)
        names = json.dumps(list(chosen))
        key = hashlib.sha256("\n".join([config, names, self._print_of(data)]).encode()).hexdigest()
        with self._lock:
            if key in self._done:
                return self._done[key]
        got = fit()
        (self.spark.createDataFrame([(key, config, names, got)], SCHEMA).coalesce(1)
         .write.parquet(f"{self.path}/{key}/{uuid.uuid4().hex}"))
        with self._lock:
            self._done[key] = got
            self.fitted += 1
        return got

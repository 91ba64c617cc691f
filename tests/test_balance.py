
import math

from pyspark.sql import functions as F

from fieldnotes.operators import balance
from fieldnotes.plans.fixtures import obs
from tests.conftest import SF_MID


def _labelled(spark):
    return obs(spark, SF_MID).filter(F.col("label_count").isNotNull())


def test_split_disjoint_complete_and_sized(spark):
    o = obs(spark, SF_MID)
    parts = balance.hash_split(o, "event_id")
    counts = {r["part"]: r["count"] for r in parts.groupBy("part").count().collect()}
    n = o.count()
    assert sum(counts.values()) == n
    sigma = math.sqrt(n * 0.7 * 0.3)
    assert abs(counts["train"] - 0.7 * n) < 5 * sigma
    a, b = balance.split(o, "event_id")
    assert a.join(b, "event_id").count() == 0
    assert a.count() + b.count() == n


def test_hash_draw_independent_of_partitioning(spark):
    o = obs(spark, SF_MID)
    one = balance.undersample(o.repartition(3), key="event_id").select("event_id")
    two = balance.undersample(o.repartition(7), key="event_id").select("event_id")
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_undersample_keeps_minority(spark):
    lab = _labelled(spark)
    sizes = {r["label"]: r["n"] for r in balance.class_counts(lab).collect()}
    minority = min(sizes, key=sizes.get)
    kept = balance.undersample(lab, key="event_id")
    got = {r["label"]: r["n"] for r in balance.class_counts(kept).collect()}
    assert got[minority] == sizes[minority]
    major = 1 - minority
    p = sizes[minority] / sizes[major]
    sigma = math.sqrt(sizes[major] * p * (1 - p))
    assert abs(got[major] - sizes[minority]) < 5 * sigma


def test_undersample_random_method(spark):
    lab = _labelled(spark)
    kept = balance.undersample(lab, method="random", seed=3)
    got = {r["label"]: r["n"] for r in balance.class_counts(kept).collect()}
    sizes = {r["label"]: r["n"] for r in balance.class_counts(lab).collect()}
    minority = min(sizes, key=sizes.get)
    assert got[minority] == sizes[minority]


def test_oversample_copies(spark):
    lab = _labelled(spark)
    sizes = {r["label"]: r["n"] for r in balance.class_counts(lab).collect()}
    out = balance.oversample(lab, key="event_id")
    got = {r["label"]: r["n"] for r in balance.class_counts(out).collect()}
    minority = min(sizes, key=sizes.get)
    major = 1 - minority
    assert got[major] == sizes[major]
    r = sizes[major] / sizes[minority]
    per_row = out.filter((F.col("label_count") > 0) == bool(minority)) \
        .groupBy("event_id").count().agg(F.min("count"), F.max("count")).first()
    assert per_row[0] == math.floor(r) and per_row[1] <= math.floor(r) + 1
    assert abs(got[minority] - sizes[major]) < 5 * math.sqrt(sizes[minority])


def test_one_class_returns_input(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 0.0), (3, None)], "k long, label_count double")
    assert balance.undersample(df, key="k").count() == 2
    assert balance.oversample(df, key="k").count() == 2
    assert balance.undersample(df, method="random").count() == 2


def test_hash_sample_rate(spark):
    o = obs(spark, SF_MID)
    n = o.count()
    kept = balance.hash_sample(o, "event_id", 0.1).count()
    assert abs(kept - 0.1 * n) < 5 * math.sqrt(n * 0.1 * 0.9)

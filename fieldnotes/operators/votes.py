"""One vote per tree (M9, M4) and the accuracy of every prefix of a forest (M8).

``spark.ml`` averages the trees' class probabilities. Here each tree gives one
class, and the class with the most votes wins (a tie goes to the smaller
class), as one-vote-per-tree forests do. A fitted forest is flattened to a
table of nodes (its saved form), at most trees * 2^(depth + 1) rows whatever
the data, and each tree is written as one SQL expression over the assembled
vector. Scoring is then a projection in the JVM: no Python worker, no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldnotes.session import scratch_path

VECTOR, VOTES = "__x", "votes"


@dataclass(frozen=True)
class Node:
    """A leaf has ``feature`` -1. Left go values up to ``threshold``, or those
    among ``categories`` (where that isn't None)."""

    prediction: int
    feature: int = -1
    threshold: float = 0.0
    categories: tuple[int, ...] | None = None
    left: int = -1
    right: int = -1


def node_table(forest) -> DataFrame:
    """``tree, node, prediction, feature, split, categories, left, right`` of a
    fitted forest stage, from its saved form in the shared folder."""
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "forest")
    forest.write().overwrite().save(path)
    rows = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"), "nodeData.prediction",
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.col("nodeData.split.leftCategoriesOrThreshold").alias("split"),
        F.col("nodeData.split.numCategories").alias("categories"),
        F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"))
    return rows


def trees_of(forest) -> list[dict[int, Node]]:
    """The trees in order, each as its nodes by id (0 is the root)."""
    spark = SparkSession.getActiveSession()
    nodes = node_table(forest)
    out: dict[int, dict[int, Node]] = {}
    for r in nodes.toLocalIterator():
        named = r["categories"] is not None and r["categories"] >= 0
        leaf = r["left"] < 0
        out.setdefault(r["tree"], {})[r["node"]] = Node(int(r["prediction"])) if leaf else Node(
            int(r["prediction"]), r["feature"], 0.0 if named else r["split"][0],
            tuple(int(c) for c in r["split"]) if named else None, r["left"], r["right"])
    folder = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(nodes.inputFiles()[0])).getParent().getParent()
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return [out[t] for t in sorted(out)]


def tree_sql(tree: dict[int, Node], vector: str = VECTOR, at: int = 0) -> str:
    """The class a tree gives, as an expression over the array ``vector``."""
    node = tree[at]
    if node.feature < 0:
        return str(node.prediction)
    if node.categories is None:
        goes_left = f"{vector}[{node.feature}] <= {node.threshold!r}D"
    else:
        goes_left = f"{vector}[{node.feature}] IN ({', '.join(f'{c}.0D' for c in node.categories) or 'NULL'})"
    left, right = tree_sql(tree, vector, node.left), tree_sql(tree, vector, node.right)
    return left if left == right else f"IF({goes_left}, {left}, {right})"


def with_votes(df: DataFrame, trees: list[dict[int, Node]], features: str = "features", out: str = VOTES) -> DataFrame:
    """``df`` (with assembled vectors) and the class each tree gives, in order."""
    votes = f"array({', '.join(tree_sql(t) for t in trees)})"
    return df.withColumn(VECTOR, vector_to_array(features)).withColumn(out, F.expr(votes)).drop(VECTOR)


def majority(votes: Column | str = VOTES, classes: int = 2) -> Column:
    """The class with the most votes; of equal ones the smallest."""
    votes = F.col(votes) if isinstance(votes, str) else votes

    def cast_for(c: int) -> Column:
        return F.size(F.filter(votes, lambda v: v == c))

    counts = F.array(*[cast_for(c) for c in range(classes)])
    return (F.array_position(counts, F.array_max(counts)) - 1).cast("int")


def assembled(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` through all stages but the forest."""
    return PipelineModel(model.stages[:-1]).transform(df)


def score_by_votes(model: PipelineModel, df: DataFrame, key: str, out: str = "prediction",
                   keep: list[str] | None = None) -> DataFrame:
    """``key, prediction`` and the columns in ``keep``: one vote per tree."""
    forest = model.stages[-1]
    voted = with_votes(assembled(model, df), trees_of(forest), forest.getFeaturesCol())
    return voted.select(F.col(key), majority(classes=forest.numClasses).alias(out), *(keep or []))


def prefix_accuracy(voted: DataFrame, label: str = "label", votes: str = VOTES) -> DataFrame:
    """``trees, n, n_correct, accuracy`` of the first 1, 2, ... trees of a
    two-class forest: running counts of votes inside each row, one aggregate
    over all rows and prefixes."""
    running = (f"aggregate({votes}, named_struct('ones', 0, 'n', 0, 'won', cast(array() AS array<int>)), "
               "(a, v) -> named_struct('ones', a.ones + v, 'n', a.n + 1, "
               "'won', concat(a.won, array(int(2 * (a.ones + v) > a.n + 1)))), a -> a.won)")
    each = voted.select(F.col(label).cast("int").alias("__label"), F.posexplode(F.expr(running)).alias("__at", "__won"))
    hit = (F.col("__won") == F.col("__label")).cast("long")
    return each.groupBy((F.col("__at") + 1).alias("trees")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(hit).alias("n_correct"), F.avg(hit.cast("double")).alias("accuracy"))

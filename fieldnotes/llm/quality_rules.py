"""Quality classifier: a sparse ensemble of rules over text statistics.

1. Each whole text gives one row of statistics.
2. On a bounded sample of labelled rows (``SAMPLE``, drawn by key hash), small
   boosted trees are grown; every path from a root is a conjunctive rule.
3. A logistic model with a lasso penalty weighs the rules; most get none.
4. The rules left are compiled into one Spark column expression, so scoring
   is a projection over the statistics.

Defined results: a NULL text counts as empty, and empty texts are scored
like any other; labels other than 0 and 1 don't train, and a document with
several labels counts as 1 if half or more say so; with no labels, or labels
of one kind only, the score is the share of ones (0.5 without any).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldnotes.llm.common import key_crc, key_hash60, pa_schema, small_batches, text_of

STATS = ("chars", "words", "word_length", "distinct_words", "top_word", "same_as_before", "short_words",
         "capitals", "digits", "signs", "bare_signs", "ends_in_sign", "lines", "same_lines", "line_length", "repeats")
SAMPLE = 20_000
TREES, DEPTH, BINS, RATE, LEAST = 40, 3, 32, 0.3, 20
PENALTY, STEPS = 0.002, 400
THRESHOLD = 0.3
BATCH = 512
_ORDINARY = frozenset(".,;:!?'\"()-")
_UPPER = np.zeros(256, bool)
_UPPER[ord("A"):ord("Z") + 1] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0"):ord("9") + 1] = True
_SIGN = np.array([33 <= i < 127 and not chr(i).isalnum() and chr(i) not in _ORDINARY for i in range(256)])


def statistics_of(text: str) -> tuple[float, ...]:
    words = text.split()
    n = len(words)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    bytes_of = np.bincount(data, minlength=256)
    size = max(1, len(data))
    lengths = list(map(len, words))
    per = 1 / max(1, n)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    last = Counter([w[-1] for w in words])
    signs_last = sum(k for c, k in last.items() if c in "!%$#&*|~^<>=+_\\/@")
    bare = sum(k for w, k in counts.items() if len(w) <= 2 and not any(map(str.isalnum, w)))
    return (float(len(text)), float(n), sum(lengths) * per, len(counts) * per,
            max(counts.values(), default=0) * per, sum(map(eq, words, words[1:])) * per,
            sum(k for w, k in counts.items() if len(w) <= 3) * per,
            float(bytes_of[_UPPER].sum()) / size, float(bytes_of[_DIGIT].sum()) / size,
            float(bytes_of[_SIGN].sum()) / size, bare * per, signs_last * per, float(len(lines)),
            1 - len(set(lines)) / max(1, len(lines)), len(text) / max(1, len(lines)),
            sum(k for k in counts.values() if k > 1) * per)


def with_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns of ``docs`` and one column per statistic."""
    small_batches(docs.sparkSession, BATCH)
    base = docs.select(*keep, text_of().alias("_text"))
    fields = ", ".join(f"{s} double" for s in STATS)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema if f.name != "_text")
    ddl = f"{kept}, {fields}"
    schema = pa_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.array([statistics_of(t) for t in batch.column("_text").to_pylist()]).reshape(-1, len(STATS))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *[pa.array(got[:, i]) for i in range(len(STATS))]], schema=schema)

    return base.mapInArrow(run, ddl)


#: A rule is a set of conditions (statistic, above or not, threshold).
Rule = frozenset


def _splits(x: np.ndarray) -> list[np.ndarray]:
    return [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]


def grow_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """Paths of boosted trees: second-order gain on the logistic loss."""
    cuts = _splits(x)
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
    margin = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    rules: dict[Rule, None] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        open_nodes = [(np.arange(len(y)), Rule())]
        leaves = []
        for _ in range(DEPTH):
            grown = []
            for rows, path in open_nodes:
                g, h = grad[rows], hess[rows]
                base = g.sum() ** 2 / (h.sum() + 1)
                best = (1e-3, None)
                for j, cut in enumerate(cuts):
                    if not len(cut):
                        continue
                    b = binned[rows, j]
                    gl = np.cumsum(np.bincount(b, g, len(cut) + 1))[:-1]
                    hl = np.cumsum(np.bincount(b, h, len(cut) + 1))[:-1]
                    nl = np.cumsum(np.bincount(b, minlength=len(cut) + 1))[:-1]
                    gain = gl ** 2 / (hl + 1) + (g.sum() - gl) ** 2 / (h.sum() - hl + 1) - base
                    gain[(nl < LEAST) | (len(rows) - nl < LEAST)] = -1
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (gain[k], (j, k))
                if best[1] is None:
                    leaves.append(rows)
                    continue
                j, k = best[1]
                above = binned[rows, j] > k
                for side in (False, True):
                    rule = path | {(j, side, float(cuts[j][k]))}
                    rules[rule] = None
                    grown.append((rows[above == side], rule))
            open_nodes = grown
        for rows in [*leaves, *(r for r, _ in open_nodes)]:
            margin[rows] += RATE * grad[rows].sum() / (hess[rows].sum() + 1)
    return list(rules)


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, above, cut in rule:
        out &= (x[:, j] > cut) == above
    return out


def lasso(z: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = STEPS) -> tuple[float, np.ndarray]:
    """Logistic weights with an L1 penalty, by accelerated proximal gradient."""
    n = len(y)
    full = np.hstack([np.ones((n, 1)), z])
    v = np.ones(full.shape[1])
    for _ in range(30):
        v = full.T @ (full @ v)
        v /= np.linalg.norm(v)
    step = 4 * n / float(v @ (full.T @ (full @ v)))
    w = np.zeros(full.shape[1])
    w[0] = np.log(y.mean() / (1 - y.mean()))
    ahead, t = w.copy(), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(full @ ahead)))
        new = ahead - step * (full.T @ (p - y)) / n
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return float(w[0]), w[1:]


@dataclass(frozen=True)
class RuleModel:
    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def column(self) -> Column:
        """The score as one expression over the statistics' columns."""
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            all_hold = F.lit(True)
            for j, above, cut in sorted(rule):
                c = F.col(STATS[j])
                all_hold = all_hold & (c > F.lit(cut) if above else c <= F.lit(cut))
            total = total + F.when(all_hold, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def describe(self) -> list[str]:
        return [f"{w:+.3f} if " + " and ".join(f"{STATS[j]} {'>' if a else '<='} {c:.4g}" for j, a, c in sorted(r))
                for r, w in sorted(self.rules, key=lambda x: -abs(x[1]))]


def fit(x: np.ndarray, y: np.ndarray) -> RuleModel:
    if not len(y):
        return RuleModel(0.0, ())
    if y.min() == y.max():
        return RuleModel(20.0 if y[0] else -20.0, ())
    rules = grow_rules(x, y)
    if not rules:
        return RuleModel(float(np.log(y.mean() / (1 - y.mean()))), ())
    bias, weights = lasso(np.stack([holds(r, x) for r in rules], 1).astype(float), y)
    return RuleModel(bias, tuple((r, float(w)) for r, w in zip(rules, weights) if w))


def held_out(column: str = "doc_id") -> Column:
    return key_crc(column) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None, most: int = SAMPLE) -> RuleModel:
    """Fit on at most about ``most`` labelled documents."""
    rows = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()
                        & (F.lit(True) if usable is None else usable))
    n = rows.count()
    sample = (rows.where(key_hash60("doc_id") < F.lit(int(min(1, most / max(1, n)) * (1 << 60))))
              .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("_good"))
              .withColumnRenamed("doc_id", "_key"))
    # `most` rows of two numbers at most: a bounded broadcast
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_key"))
    got = with_statistics(chosen, "_key", "_good").orderBy("_key", *STATS).toArrow()
    x = np.stack([got[s].to_numpy() for s in STATS], 1)
    return fit(x, got["_good"].to_numpy())


def score(docs: DataFrame, model: RuleModel, threshold: float = THRESHOLD) -> DataFrame:
    return (with_statistics(docs, "doc_id")
            .select("doc_id", held_out().alias("held_out"), model.column().alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels, ~held_out()))

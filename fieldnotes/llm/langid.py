"""Language identification: multinomial naive Bayes over hashed character
n-grams.

Training counts the hashed n-grams (1 to 3 characters, lower case, all but
letters read as a space) of a bounded sample per language: at most about
``PER_LANGUAGE`` documents, drawn by key hash. The log-probability matrix has
2^16 columns and a row per language; it goes to the tasks with the function
and scores a batch by gathering and summing in numpy.

The score compares the learned languages with each other, so a text in
another language can score high. ``accepted`` therefore asks how well the
winning language explains the text at all: its mean log probability per n-gram
must lie within ``DEVIATIONS`` standard deviations of what labelled texts that
were not trained on have in that language (``spread``). A deviation has a part
between documents and a part that shrinks with the text's length, so short
texts are judged mildly.

Defined results: a NULL text, or one without a letter (of any plane of
Unicode), is ``und`` with score 0; labels that are NULL don't train; with no
training rows at all every text is ``und``; equal texts get equal results, also
where two languages tie (the first by name wins). Very long texts are scored
whole. Rows that repeat a doc_id are each returned. An empty table gives no
rows. Columns of the input named lang_pred or score are replaced; other names
don't clash. A language without spread accepts all its texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldnotes.llm.common import key_crc, key_hash60, pa_schema, small_batches

GRAMS = (1, 2, 3)
BITS = 16
PER_LANGUAGE = 2000
MOST_LANGUAGES = 1000
SMOOTHING = 0.5
#: The score counts a text as at most so many independent n-grams.
EVIDENCE = 40
BATCH = 512
CHARS = 1 << 20
UNKNOWN = "und"
DEVIATIONS = 6.0


@cache
def _letters() -> np.ndarray:
    """Lower case of each letter of the basic plane; a space for the rest."""
    out = np.full(1 << 16, ord(" "), np.uint32)
    for i in range(1 << 16):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def normalised(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and where each begins (one more at
    the end). Letters above the basic plane stay as they are; what is no letter
    is a space there, too."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    low = _letters()[np.minimum(points, 0xFFFF)]
    high = np.unique(points[points > 0xFFFF])
    letters = np.array([p for p in high.tolist() if p < 0x110000 and chr(p).isalpha()], np.uint32)
    return np.where(np.isin(points, letters), points, np.where(points > 0xFFFF, np.uint32(ord(" ")), low)), bounds


def hashed(points: np.ndarray, n: int) -> np.ndarray:
    """Bucket of the n-gram at each position (the last n - 1 have none)."""
    if len(points) < n:
        return np.zeros(0, np.uint32)
    h = np.full(len(points) - n + 1, n, np.uint32)
    for k in range(n):
        h = (h ^ points[k:len(points) - n + 1 + k]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
    return (h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)


def _groups(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts with about CHARS characters, to bound the arrays."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHARS:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, texts[first:]


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    prior: np.ndarray
    weights: np.ndarray  # language x bucket, log probabilities

    def score(self, texts: list[str]) -> tuple[list[str], list[float]]:
        return self.explained(texts)[:2]

    def explained(self, texts: list[str]) -> tuple[list[str], list[float], list[float], list[int]]:
        """Language, score, mean log probability per n-gram and number of n-grams."""
        langs: list[str] = []
        scores: list[float] = []
        means: list[float] = []
        sizes: list[int] = []
        for _, part in _groups([t or "" for t in texts]):
            points, bounds = normalised(part)
            total = np.zeros((len(self.languages), len(part)))
            grams = np.zeros(len(part))
            for n in GRAMS:
                buckets = hashed(points, n)
                first, end = bounds[:-1], bounds[1:] - (n - 1)
                some = end > first
                if not some.any():
                    continue
                edges = np.stack([first[some], end[some]], 1).ravel()
                tail = edges[-1] >= len(buckets)
                edges = edges[:-1] if tail else edges
                for k, w in enumerate(self.weights):
                    total[k, some] += np.add.reduceat(w[buckets], edges, dtype=np.float64)[::2]
                grams[some] += (end - first)[some]
            letters = np.add.reduceat(np.append(points != ord(" "), False),
                                      np.minimum(bounds[:-1], len(points)), dtype=np.int64)
            known = (letters > 0) & (bounds[1:] > bounds[:-1])
            best = np.argmax(total + self.prior[:, None], 0)
            soft = total * np.minimum(1, EVIDENCE / np.maximum(grams, 1)) + self.prior[:, None]
            soft = np.exp(soft - soft.max(0))
            soft /= soft.sum(0)
            for i, b in enumerate(best):
                langs.append(self.languages[b] if known[i] else UNKNOWN)
                scores.append(float(soft[b, i]) if known[i] else 0.0)
                means.append(float(total[b, i] / max(1, grams[i])))
                sizes.append(int(grams[i]))
        return langs, scores, means, sizes


def train(docs: DataFrame, usable: Column | None = None, per_language: int = PER_LANGUAGE) -> Model:
    """Fit on the rows of ``docs`` (doc_id, text, lang) that ``usable`` allows."""
    spark = docs.sparkSession
    small_batches(spark, BATCH)
    lang = F.col("lang").cast("string")
    rows = docs.where(lang.isNotNull() & F.col("text").isNotNull() & (F.lit(True) if usable is None else usable))
    counts = {r["lang"]: r["n"] for r in
              rows.groupBy(lang.alias("lang")).agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    names = tuple(sorted(counts))
    if not names:
        return Model((UNKNOWN,), np.zeros(1), np.zeros((1, 1 << BITS), np.float32))
    share = F.create_map(*[x for n in names for x in
                           (F.lit(n), F.lit(int(min(1, per_language / counts[n]) * (1 << 60))))])
    sample = rows.where(key_hash60("doc_id") < share[lang])
    schema = "lang int, bucket int, n bigint"
    out = pa_schema(schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(names), 1 << BITS), np.int64)
        at = {n: k for k, n in enumerate(names)}
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                points, _ = normalised([text])
                for n in GRAMS:
                    sums[at[name]] += np.bincount(hashed(points, n), minlength=1 << BITS)
        k, bucket = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(k, pa.int32()), pa.array(bucket, pa.int32()), pa.array(sums[k, bucket])], schema=out)

    got = (sample.select(lang, F.col("text").cast("string")).mapInArrow(count, schema)
           .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())  # languages x 2^16 rows at most
    weights = np.full((len(names), 1 << BITS), SMOOTHING)
    weights[got["lang"].to_numpy(), got["bucket"].to_numpy()] += got["n"].to_numpy()
    weights = np.log(weights / weights.sum(1, keepdims=True)).astype(np.float32)
    n = np.array([counts[x] for x in names], float)
    return Model(names, np.log(n / n.sum()), weights)


def _scored(docs: DataFrame, model: Model, kept: list[str]) -> DataFrame:
    """The kept columns, and a struct ``_got`` of lang_pred, score, mean log
    probability and number of n-grams."""
    small_batches(docs.sparkSession, BATCH)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages (bounded) x 2^16 floats

    @F.pandas_udf("lang_pred string, score double, mean double, grams bigint")
    def scored(texts):  # Iterator[Series] -> Iterator[DataFrame]
        import pandas as pd
        got = shared.value.explained([t if isinstance(t, str) else "" for t in texts])
        return pd.DataFrame(dict(zip(("lang_pred", "score", "mean", "grams"), got)))

    return docs.select(*[docs[c] for c in kept], scored(docs["text"].cast("string")).alias("_got"))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score appended; columns of ``docs`` with
    those names are replaced."""
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    got = _scored(docs, model, kept)
    return got.select(*[got[c] for c in kept], "_got.lang_pred", "_got.score")


def spread(docs: DataFrame, model: Model, usable: Column | None = None) -> dict[str, tuple[float, float, float]]:
    """By language: mean of the documents' mean log probabilities, their
    variance, and what one n-gram adds to it, from labelled rows that ``usable``
    allows and whose label is predicted. One aggregate, a row per language.

    The variance of a document's mean is that between documents and v / n;
    regressing it on 1 / n over the documents separates the two."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.lit(True) if usable is None else usable))
    got = _scored(rows, model, ["lang"]).where((F.col("_got.lang_pred") == F.col("lang")) & (F.col("_got.grams") > 0))
    mean, per = F.col("_got.mean"), 1 / F.col("_got.grams")
    sums = got.groupBy("lang").agg(
        F.avg(mean).alias("mean"), F.var_pop(mean).alias("all"), F.avg(per).alias("per"), F.count(F.lit(1)).alias("n"))
    off = got.join(F.broadcast(sums.select(F.col("lang").alias("_of"), F.col("mean").alias("_m"), F.col("per").alias("_p"))),
                   F.col("lang") == F.col("_of"))
    slope = off.groupBy("lang").agg(F.try_divide(
        F.covar_pop(F.pow(mean - F.col("_m"), 2), per), F.var_pop(per)).alias("slope"))
    out = {}
    for r in sums.join(slope, "lang").collect():
        one = max(0.0, r["slope"] or 0.0)
        out[r["lang"]] = (r["mean"], max(r["all"] - one * r["per"], 0.01 * r["all"]), one)
    return out


def accepted(docs: DataFrame, model: Model, limits: dict[str, tuple[float, float, float]],
             deviations: float = DEVIATIONS) -> DataFrame:
    """The rows of ``docs``, unchanged, whose language is known and explains
    the text as ``limits`` (``spread``) say."""
    got = _scored(docs, model, docs.columns)
    lang, mean, grams = F.col("_got.lang_pred"), F.col("_got.mean"), F.col("_got.grams")
    fits = F.lit(True)
    for name, (middle, between, one) in limits.items():
        least = F.lit(middle) - deviations * F.sqrt(F.lit(between) + F.lit(one) / grams)
        fits = F.when(lang == name, mean >= least).otherwise(fits)
    return got.where((lang != UNKNOWN) & fits).select(*[got[c] for c in docs.columns])


def held_out(column: str = "doc_id") -> Column:
    return key_crc(column) % 4 == 2


def identify(docs: DataFrame) -> DataFrame:
    """Train on the rows that are not held out, predict all."""
    return predict(docs, train(docs, ~held_out()))

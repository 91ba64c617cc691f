"""The corpus pipeline: five stages from ``documents`` to packed sequences.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and reread as the next one's
docs. All but the last return the columns of ``documents``:

1. ``language_id`` drops texts without a letter, and texts that the language
   predicted for them explains worse than labelled texts of that language by
   more than six standard deviations: junk, and languages not learned. Labels
   of three quarters of the documents train the model, the others' give the
   deviations;
2. ``near_dedup`` keeps one document of each group of near duplicates
   (five-word shingles, similarity 0.8 or more);
3. ``pii`` replaces personal data by its kind;
4. ``mixing`` repeats or drops documents to reach the sources' targets, so a
   doc_id may come twice from here on;
5. ``packing`` packs all that is left into sequences of 2048 tokens.

NULL and empty texts go in the first stage. Rows that repeat a doc_id are
documents of their own until ``near_dedup``, which keeps one row of each text
under the smallest doc_id of its group. Very long texts are taken whole. An
empty table stays empty through all stages. Other columns of the documents
come along to the last stage but one, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldnotes.llm import langid, minhash_join, mixing, packing, pii
from fieldnotes.llm.common import documents, prepare, stage
from fieldnotes.llm.queries import WORD_TOKENIZER, tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    model = langid.train(docs, ~langid.held_out())
    return langid.accepted(docs, model, langid.spread(docs, model, langid.held_out()))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return minhash_join.keep_one(docs, size=5, num=80, den=100)


def pii_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pii.masked_documents(docs, pii.train(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(docs, tokenizer_path(WORD_TOKENIZER))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("pii", pii_masking),
          ("mixing", mix), ("packing", pack)]

#: The stages are fitted models and a signature join: not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the last one's rows."""
    docs = documents(spark, sf_dir)
    for name, stage_of in STAGES[:-1]:
        docs = stage(stage_of(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

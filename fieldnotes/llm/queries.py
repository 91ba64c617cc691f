"""The registered queries of this subpackage, and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldnotes.llm import (alignment, langid, lexical_trie, minhash_join, mixing, ngram_join, packing, pii, pivot_topk,
                            quality_rules, records, suffix_dedup, syncmers)
from fieldnotes.llm.common import documents, prepare

#: Files of public tokenizers, by name; their folder is a parameter.
WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.classify(documents(spark, sf_dir), labels)


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path(WORD_TOKENIZER))


def op3_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.round_trip(documents(spark, sf_dir), tokenizer_path(BYTE_TOKENIZER))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return langid.identify(docs).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return pivot_topk.top_k(rows, F.col("vec_id") % 20 == 0)


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(mixing.sized(documents(spark, sf_dir))).select(
        "doc_id", "size", "source_size", "target", "taken")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return pii.find(docs, pii.train(docs))


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(documents(spark, sf_dir))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.near_duplicates(documents(spark, sf_dir), size=3, num=85, den=100)


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_classes(documents(spark, sf_dir), size=4, num=85, den=100)


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(documents(spark, sf_dir), tokenizer_path(BYTE_TOKENIZER), tokenizer_path(PIECE_TOKENIZER))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return lexical_trie.search(documents(spark, sf_dir), items, k=10)


QUERIES = {
    "op1_quality": op1_quality,
    "op2_pack": op2_pack,
    "op3_records": op3_records,
    "op4_language": op4_language,
    "op5_repeats": op5_repeats,
    "op6_topk": op6_topk,
    "op7_mix": op7_mix,
    "op8_pii": op8_pii,
    "op9_fingerprint": op9_fingerprint,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_ngram_join": op11_ngram_join,
    "op12_align": op12_align,
    "op13_lexical_search": op13_lexical_search,
}

# size by words; source targets by water level; thresholds by running sums in
# hash order (what the nested histograms find without sorting)
OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM d GROUP BY source),
w AS (
  SELECT *, [3, 1, 2][(place % 3 + 1)::INT] AS weight, 2 * source_size AS cap FROM s),
l AS (
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, place
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, place
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS lev
  FROM w),
t AS (
  SELECT source, source_size,
         least(cap::DOUBLE, (max(lev) OVER ()) * weight) AS target FROM l),
r AS (
  SELECT d.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS passes,
         sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (passes + (upto <= target - passes * source_size)::INT))::BIGINT AS taken
FROM r
"""

OP6_SQL = """
WITH v AS (
  SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum([z[1] * z[2] FOR z IN list_zip(q.e, c.e)])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20
"""

# every 400-byte string by its hash; starts that recur; the runs they cover
OP5_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS data FROM documents),
n AS (SELECT r, doc_id, data, hex(data) AS hx, octet_length(data)::BIGINT AS n_bytes FROM d),
w AS (
  SELECT r, i, md5(array_slice(data, i + 1, i + 400)) AS m
  FROM (SELECT r, data, unnest(range(0, n_bytes - 399)) AS i FROM n)),
t AS (SELECT m FROM w GROUP BY m HAVING count(*) > 1),
s AS (
  SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 400 THEN 0 ELSE 1 END AS new
  FROM w SEMI JOIN t USING (m)),
g AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS run FROM s),
u AS (SELECT r, run, min(i) AS lo, max(i) + 400 AS hi FROM g GROUP BY r, run),
k AS (
  SELECT r, lo, hi, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY lo), 0) AS free FROM u),
c AS (
  SELECT k.r, count(*) AS n_spans, sum(hi - lo) AS n_removed, max(hi) AS last,
         string_agg(substr(hx, 2 * free + 1, 2 * (lo - free)), '' ORDER BY lo) AS head
  FROM k JOIN n ON k.r = n.r GROUP BY k.r)
SELECT doc_id, n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(hx, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM n LEFT JOIN c ON n.r = c.r
"""

# shingle sets, all pairs that share a shingle, and what each text can reach
_CLASSES = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
x AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= {size} THEN [array_to_string(w[i:i + {size} - 1], ' ') FOR i IN range(1, len(w) - {size} + 2)]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM d),
n AS (SELECT doc_id, count(*) AS n FROM x GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
      FROM x a JOIN x b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * common >= 85 * (na.n + nb.n - common)),
r AS (SELECT doc_id, doc_id AS seen FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.seen),
c AS (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY doc_id)
SELECT c.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, {columns}
FROM c LEFT JOIN n ON n.doc_id = c.doc_id
"""
OP10_SQL = _CLASSES.format(size=3, columns="component_id, c.doc_id = component_id AS kept")
OP11_SQL = _CLASSES.format(size=4, columns="component_id")

# tf of the items' terms by document row; scores in 64-bit integers
OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents),
c AS (SELECT count(*) FILTER (len(t) > 0)::BIGINT AS docs, sum(len(t))::BIGINT AS terms FROM d),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
f AS (
  SELECT r, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT r, doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM d) GROUP BY ALL),
w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM f, c GROUP BY term, docs),
s AS (
  SELECT item_id, r, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
  FROM q JOIN f USING (term) JOIN w USING (term), c GROUP BY item_id, r, doc_id)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM s WHERE score > 0)
WHERE rank <= 10
"""

ORACLES = {"op5_repeats": OP5_SQL, "op6_topk": OP6_SQL, "op7_mix": OP7_SQL, "op10_near_duplicates": OP10_SQL,
           "op11_ngram_join": OP11_SQL, "op13_lexical_search": OP13_SQL}

"""DuckDB SQL for the registered queries (same column names and types).

Written from the operator definitions, not from the Spark code, over the
pre-registered test-table views. ``OBS_CTE`` builds the observation table.
"""

from __future__ import annotations

from fieldnotes.functions.hashing import uniform_sql
from fieldnotes.plans.fixtures import OBS_CTE
from fieldnotes.spec import CHECKLIST_DEFAULT_FEATURES


def _u(key: str, salt: str | None = None) -> str:
    return uniform_sql(key if salt is None else f"CAST({key} AS VARCHAR) || '#{salt}'")


_OBS_NUMERIC = ("f_day", "f_hour", "f_effort", "label_count")


def _union(parts) -> str:
    return "\n  UNION ALL ".join(parts)


_CELLS = _union(
    f"SELECT event_id, '{c}' AS feature, {c} AS value, label_count FROM obs WHERE {c} IS NOT NULL"
    for c in _OBS_NUMERIC)

_CATEGORY_VALUES = _union(
    f"SELECT DISTINCT '{c}' AS feature, {c} AS category FROM {t} WHERE {c} IS NOT NULL"
    for t, cols in (("lineitem", ("l_returnflag", "l_linestatus")),
                    ("orders", ("o_orderstatus", "o_orderpriority")),
                    ("part", ("p_brand", "p_type")))
    for c in cols)

_LINEITEM_CELLS = _union(
    f"SELECT '{c}' AS feature, {c} AS value, l_quantity AS label_count FROM lineitem"
    f" WHERE {c} IS NOT NULL"
    for c in ("l_extendedprice", "l_discount", "l_tax"))


def _pearson_cte(cells: str, label_mean: str) -> str:
    """CTEs ending in ``sc(feature, score)`` with unrounded scores."""
    return f"""
, cells AS ({cells})
, ybar AS (SELECT {label_mean} AS yb)
, s AS (SELECT feature, CAST(count(value) AS DOUBLE) AS n, sum(value) AS sx,
          sum(value * value) AS sxx, sum(label_count * label_count) AS syy,
          sum(value * label_count) AS sxy
        FROM cells WHERE label_count IS NOT NULL GROUP BY feature)
, m AS (SELECT feature, sxx / n - (sx / n) * (sx / n) AS vx, syy / n - yb * yb AS vy,
          sxy / n - (sx / n) * yb AS cov FROM s, ybar)
, sc AS (SELECT feature, CASE WHEN vx > 0 AND vy > 0 THEN abs(cov / (sqrt(vx) * sqrt(vy)))
                              ELSE 0 END AS score FROM m)
"""


def _pearson(cells: str, label_mean: str) -> str:
    return _pearson_cte(cells, label_mean) + "SELECT feature, round(score, 6) AS score FROM sc"


def _pairwise(cells: str) -> str:
    return f"""
, cells AS ({cells})
, r AS (SELECT feature, corr(value, label_count) AS r FROM cells
        WHERE label_count IS NOT NULL GROUP BY feature)
SELECT feature, round(CASE WHEN r IS NULL OR isnan(r) OR isinf(r) THEN 0 ELSE abs(r) END, 6)
  AS score FROM r"""


def _chi(feature_name: str, cells: str) -> str:
    return f"""
, c AS ({cells})
, t AS (SELECT category,
          CAST(sum(CASE WHEN label_count = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS n0,
          CAST(sum(CASE WHEN label_count <> 0 THEN 1 ELSE 0 END) AS DOUBLE) AS n1
        FROM c WHERE label_count IS NOT NULL GROUP BY category)
, w AS (SELECT *, sum(n0) OVER () AS t0, sum(n1) OVER () AS t1 FROM t)
, e AS (SELECT *, (n0 + n1) / (t0 + t1) * t0 AS e0, (n0 + n1) / (t0 + t1) * t1 AS e1 FROM w)
SELECT '{feature_name}' AS feature,
  round(CASE WHEN min(t0) > 0 AND min(t1) > 0
             THEN sum((n0 - e0) * (n0 - e0) / e0 + (n1 - e1) * (n1 - e1) / e1) END, 6) AS score
FROM e"""


_SIZES = """, sizes AS (SELECT
    CAST(sum(CASE WHEN label_count = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS n0,
    CAST(sum(CASE WHEN label_count > 0 THEN 1 ELSE 0 END) AS DOUBLE) AS n1
  FROM obs WHERE label_count IS NOT NULL)
"""

ORACLES: dict[str, str] = {
    "parse_cells": OBS_CTE + """
SELECT event_id, sampling_id, f_day, f_hour, f_effort, f_kind, label_count FROM obs""",

    "id_digits": OBS_CTE + r"""
SELECT event_id, sampling_id,
  CAST(nullif(regexp_extract(sampling_id, '(\d+)', 1), '') AS DOUBLE) AS id_number FROM obs""",

    "binary_label": OBS_CTE + """
SELECT event_id, label_count, CAST(CASE WHEN label_count > 0 THEN 1 ELSE 0 END AS DOUBLE) AS label
FROM obs WHERE label_count IS NOT NULL""",

    "long_form": OBS_CTE + "\n" + _union(
        f"SELECT event_id, '{c}' AS feature, {c} AS value FROM obs"
        f" WHERE {c} IS NULL OR {c} <> 0" for c in _OBS_NUMERIC),

    "unpivot_zero_fill": OBS_CTE + "\n" + _CELLS,

    "category_values": _CATEGORY_VALUES,

    "category_codes": f"""
SELECT feature, category,
  CAST(row_number() OVER (PARTITION BY feature ORDER BY category) - 1 AS INTEGER) AS code
FROM ({_CATEGORY_VALUES}) v""",

    "encode_categories": OBS_CTE + """
, d AS (SELECT category, CAST(row_number() OVER (ORDER BY category) - 1 AS INTEGER) AS code
        FROM (SELECT DISTINCT f_kind AS category FROM obs WHERE f_kind IS NOT NULL) x)
SELECT event_id, f_kind, d.code AS f_kind_code FROM obs LEFT JOIN d ON obs.f_kind = d.category""",

    "feature_means": OBS_CTE + "\n" + _union(
        f"SELECT '{c}' AS feature, count({c}) AS n, round(avg({c}), 6) AS mean FROM obs"
        for c in _OBS_NUMERIC),

    "feature_means_lineitem": _union(
        f"SELECT '{c}' AS feature, count({c}) AS n, round(avg({c}), 6) AS mean FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),

    "feature_modes": OBS_CTE + """
, c AS (SELECT 'f_kind' AS feature, f_kind AS category FROM obs WHERE f_kind IS NOT NULL
        UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM orders WHERE o_orderstatus IS NOT NULL
        UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders
                  WHERE o_orderpriority IS NOT NULL)
, n AS (SELECT feature, category, count(*) AS n FROM c GROUP BY feature, category)
, r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, category) AS rn FROM n)
SELECT feature, category AS mode, n AS mode_count FROM r WHERE rn = 1""",

    "pearson_scores": OBS_CTE + _pearson(
        _union(f"SELECT '{c}' AS feature, {c} AS value, label_count FROM obs WHERE {c} IS NOT NULL"
               for c in ("f_day", "f_hour", "f_effort")),
        "(SELECT avg(label_count) FROM obs)"),

    "pearson_pairwise": OBS_CTE + _pairwise(
        _union(f"SELECT '{c}' AS feature, {c} AS value, label_count FROM obs WHERE {c} IS NOT NULL"
               for c in ("f_day", "f_hour", "f_effort"))),

    "pearson_scores_lineitem": "WITH dummy AS (SELECT 1)" + _pearson(
        _LINEITEM_CELLS, "(SELECT avg(l_quantity) FROM lineitem)"),

    "pearson_pairwise_lineitem": "WITH dummy AS (SELECT 1)" + _pairwise(_LINEITEM_CELLS),

    "chi_squared_scores": OBS_CTE + _chi(
        "f_kind", "SELECT f_kind AS category, label_count FROM obs WHERE f_kind IS NOT NULL"),

    "chi_squared_orders": "WITH dummy AS (SELECT 1)" + _chi(
        "o_orderpriority",
        "SELECT o_orderpriority AS category,"
        " CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS DOUBLE) AS label_count"
        " FROM orders WHERE o_orderpriority IS NOT NULL"),

    "class_counts": OBS_CTE + """
SELECT CAST(CASE WHEN label_count > 0 THEN 1 ELSE 0 END AS INTEGER) AS label, count(*) AS n
FROM obs WHERE label_count IS NOT NULL GROUP BY 1""",

    "class_counts_labels": """
SELECT 'quality' AS target, CAST(quality AS INTEGER) AS label, count(*) AS n FROM labels
WHERE quality IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'toxic' AS target, CAST(toxic AS INTEGER) AS label, count(*) AS n FROM labels
WHERE toxic IS NOT NULL GROUP BY 2""",

    "train_holdout_split": OBS_CTE + f"""
SELECT event_id, CASE WHEN {_u('event_id')} < 0.7 THEN 'train' ELSE 'holdout' END AS part
FROM obs""",

    "undersample": OBS_CTE + _SIZES + f"""
SELECT event_id, CAST(CASE WHEN label_count > 0 THEN 1 ELSE 0 END AS INTEGER) AS label
FROM obs, sizes
WHERE label_count IS NOT NULL AND (
  n0 = 0 OR n1 = 0
  OR (n1 < n0 AND (label_count > 0 OR {_u('event_id', 'sample')} < n1 / n0))
  OR (n1 >= n0 AND (label_count = 0 OR {_u('event_id', 'sample')} < n0 / n1)))""",

    "oversample_copies": OBS_CTE + _SIZES + f"""
, k AS (SELECT event_id, CAST(CASE WHEN label_count > 0 THEN 1 ELSE 0 END AS INTEGER) AS label,
    CASE WHEN n0 = 0 OR n1 = 0 THEN 1
         WHEN n0 > n1 THEN CASE WHEN label_count > 0 THEN floor(n0 / n1)
              + CASE WHEN {_u('event_id', 'sample')} < n0 / n1 - floor(n0 / n1) THEN 1 ELSE 0 END
              ELSE 1 END
         ELSE CASE WHEN label_count = 0 THEN floor(n1 / n0)
              + CASE WHEN {_u('event_id', 'sample')} < n1 / n0 - floor(n1 / n0) THEN 1 ELSE 0 END
              ELSE 1 END END AS k
  FROM obs, sizes WHERE label_count IS NOT NULL)
SELECT event_id, label, CAST(unnest(range(CAST(k AS BIGINT))) AS INTEGER) AS copy
FROM k WHERE k > 0""",

    "sample_rows": f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
WHERE {_u('o_orderkey')} < 0.01""",
}


_OBS_CONT_CELLS = _union(
    f"SELECT '{c}' AS feature, {c} AS value, label_count FROM obs WHERE {c} IS NOT NULL"
    for c in ("f_day", "f_hour", "f_effort"))

_TUNING = r"^(?:depth (\d+): accuracy (\d+\.\d+))"

ORACLES.update({
    "fill_missing": OBS_CTE + """
, mk AS (SELECT f_kind AS mode FROM (SELECT f_kind, count(*) AS n FROM obs
         WHERE f_kind IS NOT NULL GROUP BY f_kind) x ORDER BY n DESC, f_kind LIMIT 1)
SELECT event_id,
  round(coalesce(f_day, (SELECT avg(f_day) FROM obs)), 6) AS f_day,
  round(coalesce(f_hour, (SELECT avg(f_hour) FROM obs)), 6) AS f_hour,
  round(coalesce(f_effort, (SELECT avg(f_effort) FROM obs)), 6) AS f_effort,
  coalesce(f_kind, (SELECT mode FROM mk)) AS f_kind
FROM obs""",

    "candidate_features": OBS_CTE + _pearson_cte(
        _OBS_CONT_CELLS, "(SELECT avg(label_count) FROM obs)") + """
SELECT feature, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (ORDER BY score DESC, feature) AS rank FROM sc WHERE score > 0) r
WHERE rank <= 2""",

    "accuracy_of_rule": OBS_CTE + f"""
SELECT CASE WHEN u < 0.7 THEN 'train' ELSE 'holdout' END AS part, count(*) AS n,
  CAST(sum(hit) AS BIGINT) AS n_correct, round(avg(CAST(hit AS DOUBLE)), 6) AS accuracy
FROM (SELECT {_u('event_id')} AS u,
        CASE WHEN (CASE WHEN label_count > 0 THEN 1 ELSE 0 END)
                = (CASE WHEN coalesce(f_effort, -1.0) > 25 THEN 1 ELSE 0 END) THEN 1 ELSE 0 END AS hit
      FROM obs WHERE label_count IS NOT NULL) x
GROUP BY 1""",

    "best_trial": OBS_CTE + """
, g AS (SELECT f_hour AS h,
          CAST(sum(CASE WHEN label_count = 0 THEN 1 ELSE 0 END) AS BIGINT) AS neg,
          CAST(sum(CASE WHEN label_count > 0 THEN 1 ELSE 0 END) AS BIGINT) AS pos
        FROM obs WHERE label_count IS NOT NULL AND f_hour IS NOT NULL GROUP BY f_hour)
, c AS (SELECT h,
          coalesce(sum(neg) OVER (ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            AS neg_below,
          sum(pos) OVER () - coalesce(sum(pos) OVER (ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING
            AND 1 PRECEDING), 0) AS pos_above,
          sum(neg + pos) OVER () AS total,
          row_number() OVER (ORDER BY h) AS trial
        FROM g)
, t AS (SELECT 'stump:f_hour' AS search, CAST(trial AS INTEGER) AS trial,
          'f_hour>=' || CAST(h AS VARCHAR) AS params,
          CAST(neg_below + pos_above AS DOUBLE) / CAST(total AS DOUBLE) AS accuracy FROM c)
SELECT search, trial, params, round(accuracy, 6) AS accuracy FROM t
ORDER BY accuracy DESC, trial LIMIT 1""",

    "id_order_check": OBS_CTE + """
, a AS (SELECT row_number() OVER (ORDER BY event_id) - 1 AS position, sampling_id AS in_id FROM obs)
, b AS (SELECT row_number() OVER (ORDER BY event_id) - 1 AS position, sampling_id AS out_id
        FROM obs WHERE label_count IS NOT NULL)
, j AS (SELECT * FROM a FULL OUTER JOIN b USING (position))
SELECT 'n_input' AS metric, count(in_id) AS n FROM j
UNION ALL SELECT 'n_output', count(out_id) FROM j
UNION ALL SELECT 'n_mismatch', CAST(sum(CASE WHEN in_id IS DISTINCT FROM out_id THEN 1 ELSE 0 END)
                                    AS BIGINT) FROM j
UNION ALL SELECT 'n_missing', count(*) FROM (SELECT in_id FROM a EXCEPT ALL SELECT out_id FROM b) m
UNION ALL SELECT 'n_extra', count(*) FROM (SELECT out_id FROM b EXCEPT ALL SELECT in_id FROM a) e""",

    "tuning_curve": f"""
WITH l AS (SELECT (CASE WHEN event_type = 'error' THEN 'feature ' ELSE 'depth ' END)
    || CAST(user_id % 12 + 1 AS VARCHAR) || ': accuracy 0.'
    || lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0') AS line FROM events)
SELECT round(CAST(regexp_extract(line, '{_TUNING}', 1) AS DOUBLE), 6) AS x,
       round(CAST(regexp_extract(line, '{_TUNING}', 2) AS DOUBLE), 6) AS y
FROM l WHERE regexp_matches(line, '{_TUNING}')""",

    "clean_names": """
SELECT event_id AS "EVENT_ID", value AS "VALUE", value AS "VALUE1", user_id AS "VALUE2",
       event_type AS "EVENT_TYPE" FROM events""",

    "prediction_sink": OBS_CTE + """
SELECT sampling_id AS "SAMPLING_EVENT_ID" FROM obs""",
})

# the sparse plans compute the same measures
ORACLES["feature_means_sparse"] = ORACLES["feature_means"]
ORACLES["pearson_scores_sparse"] = ORACLES["pearson_scores"]
ORACLES["pearson_scores_lineitem_sparse"] = ORACLES["pearson_scores_lineitem"]

_DOCS = """WITH d AS (
  SELECT documents.doc_id, CAST(n_chars AS DOUBLE) AS n_chars, lang, source,
         CAST(quality AS DOUBLE) AS label_count
  FROM documents JOIN labels ON documents.doc_id = labels.doc_id)
"""


def _chi_multi(features, src: str) -> str:
    cells = _union(f"SELECT '{c}' AS feature, {c} AS category, label_count FROM {src}"
                   f" WHERE {c} IS NOT NULL" for c in features)
    return f"""
, c AS ({cells})
, t AS (SELECT feature, category,
          CAST(sum(CASE WHEN label_count = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS n0,
          CAST(sum(CASE WHEN label_count <> 0 THEN 1 ELSE 0 END) AS DOUBLE) AS n1
        FROM c WHERE label_count IS NOT NULL GROUP BY feature, category)
, w AS (SELECT *, sum(n0) OVER (PARTITION BY feature) AS t0,
          sum(n1) OVER (PARTITION BY feature) AS t1 FROM t)
, e AS (SELECT *, (n0 + n1) / (t0 + t1) * t0 AS e0, (n0 + n1) / (t0 + t1) * t1 AS e1 FROM w)
SELECT feature,
  round(CASE WHEN min(t0) > 0 AND min(t1) > 0
             THEN sum((n0 - e0) * (n0 - e0) / e0 + (n1 - e1) * (n1 - e1) / e1) END, 6) AS score
FROM e GROUP BY feature"""


ORACLES["chi_squared_docs"] = _DOCS + _chi_multi(("lang", "source"), "d")
ORACLES["pearson_scores_docs"] = _DOCS + _pearson(
    "SELECT 'n_chars' AS feature, n_chars AS value, label_count FROM d WHERE n_chars IS NOT NULL",
    "(SELECT avg(label_count) FROM d)")
ORACLES["category_codes_sorted"] = ORACLES["category_codes"]

# columns that hold nothing to measure: all zero, all missing, constant, zero
# or missing
_ODD = OBS_CTE + """
, odd AS (SELECT label_count, f_effort, 0.0e0 AS f_zero, CAST(NULL AS DOUBLE) AS f_missing,
    2011.3e0 AS f_const, CASE WHEN event_id % 2 = 0 THEN 0.0e0 END AS f_null FROM obs)
"""
_ODD_NAMES = ("f_effort", "f_zero", "f_missing", "f_const", "f_null")
ORACLES["feature_means_odd"] = _ODD + _union(
    f"SELECT '{c}' AS feature, count({c}) AS n, round(avg({c}), 6) AS mean FROM odd"
    for c in (*_ODD_NAMES, "label_count"))
_ODD_SCORES = _union(
    f"""SELECT '{c}' AS feature, round(coalesce(CASE WHEN var_pop(x) * (avg(y * y) - ybar * ybar) > 0 THEN
      abs((avg(x * y) - avg(x) * ybar) / sqrt(var_pop(x) * (avg(y * y) - ybar * ybar))) END, 0), 6) AS score
      FROM (SELECT {c} AS x, label_count AS y, (SELECT avg(label_count) FROM odd) AS ybar FROM odd
            WHERE label_count IS NOT NULL AND {c} IS NOT NULL) GROUP BY ybar"""
    for c in _ODD_NAMES if c != "f_missing") + " UNION ALL SELECT 'f_missing', 0.0e0"
ORACLES["pearson_scores_odd"] = _ODD + _ODD_SCORES
ORACLES["pearson_pairwise_odd"] = _ODD + _union(
    f"""SELECT '{c}' AS feature, round(coalesce(CASE WHEN var_pop(x) > 0 THEN abs(corr(x, y)) END, 0), 6) AS score
      FROM (SELECT {c} AS x, label_count AS y FROM odd WHERE label_count IS NOT NULL AND {c} IS NOT NULL)"""
    for c in _ODD_NAMES)
ORACLES["rank_scores"] = _ODD + f"""
SELECT feature, score, row_number() OVER (ORDER BY score DESC, feature)::INT AS place FROM ({_ODD_SCORES}) s"""

# the planted label: an hour from 12 on
ORACLES["model_roundtrip"] = OBS_CTE + "SELECT sampling_id, 1 AS same FROM obs"
ORACLES["forest_planted"] = OBS_CTE + "SELECT sampling_id, (f_hour >= 12)::INT AS prediction FROM obs"
ORACLES["forest_planted_accuracy"] = OBS_CTE + f"""
SELECT holdout, 1.0e0 AS accuracy, (SELECT count(*) FROM obs WHERE {_u('event_id', 'split')} >= 0.7) AS n_holdout
FROM (VALUES ('balanced'), ('natural'), ('refit')) t(holdout)"""
ORACLES["searches_planted"] = """
SELECT * FROM (VALUES ('prefix', 'f_hour', 1.0e0), ('greedy', 'f_hour', 1.0e0), ('maxDepth', '1', 1.0e0))
t(search, best, accuracy)"""
_KINDS = """, kinds AS (SELECT kind, (row_number() OVER (ORDER BY kind) - 1)::DOUBLE AS code
  FROM (SELECT DISTINCT f_kind AS kind FROM obs WHERE f_kind IS NOT NULL))
"""
ORACLES["model_files"] = OBS_CTE + _KINDS + """
SELECT * FROM (VALUES ('feature', 'f_day', 0e0), ('feature', 'f_hour', 1e0), ('feature', 'f_effort', 2e0),
  ('feature', 'f_kind', 3e0), ('replace', 'f_day', -1e0), ('replace', 'f_hour', -1e0), ('replace', 'f_effort', 7.5e0))
t(part, name, value)
UNION ALL SELECT 'category', 'f_kind:' || kind, code FROM kinds"""
_VECTORS = OBS_CTE + _KINDS + """, v AS (
  SELECT event_id, label_count, coalesce(f_day, -1) AS v_f_day, coalesce(f_hour, -1) AS v_f_hour,
    round(coalesce(f_effort, -1), 6) AS v_f_effort,
    coalesce(code, (SELECT count(*) FROM kinds))::DOUBLE AS v_f_kind
  FROM obs LEFT JOIN kinds ON f_kind = kind)
"""
ORACLES["feature_vectors"] = _VECTORS + "SELECT event_id, v_f_day, v_f_hour, v_f_effort, v_f_kind FROM v"
ORACLES["labelled_points"] = _VECTORS + """
SELECT event_id, (label_count > 0)::INT::DOUBLE AS label, v_f_hour, v_f_kind FROM v WHERE label_count IS NOT NULL"""
ORACLES["category_arity"] = OBS_CTE + """
SELECT 'f_kind' AS feature, count(DISTINCT f_kind) + 1 AS arity FROM obs"""
ORACLES["csv_scan"] = OBS_CTE + "SELECT sampling_id, f_day, f_hour, f_effort, f_kind, label_count FROM obs"
ORACLES["excluded_columns"] = OBS_CTE + "SELECT sampling_id, f_hour, f_effort, label_count FROM obs"
ORACLES["file_sample"] = OBS_CTE + f"""
SELECT sampling_id, f_hour, f_kind, label_raw AS label_count FROM obs_raw WHERE {_u('sampling_id', '17')} < 0.1"""
ORACLES["predictions_in_order"] = OBS_CTE + """
SELECT sampling_id, (f_hour >= 12)::INT AS prediction, row_number() OVER (ORDER BY event_id) - 1 AS position FROM obs"""
ORACLES["trial_table"] = """
SELECT * FROM (VALUES ('prefix', 1, 'features=1', 1.0e0), ('final', 2, 'continuous=3 categorical=1 trees=1 depth=1', 1.0e0))
t(search, trial, params, accuracy)"""
ORACLES["partition_by_feature"] = OBS_CTE + _union(
    f"SELECT '{c}' AS feature, count({c}) AS n, 1 AS n_partitions FROM obs" for c in _OBS_NUMERIC)
_VOTERS = """WITH e AS (SELECT event_id, event_id % 2 AS y, event_id // 2 AS h FROM events),
x AS (SELECT event_id, concat('S', event_id::VARCHAR) AS sampling_id, y,
        CASE WHEN h % 10 = 0 THEN 1 - y ELSE y END AS x1,
        CASE WHEN h % 5 IN (1, 2) THEN 1 - y ELSE y END AS x2,
        CASE WHEN h % 5 IN (3, 4) THEN 1 - y ELSE y END AS x3 FROM e)
"""
# the strong tree's leaves hold 9 in 10, the weak ones' 6 in 10: (0.9 + 0.4 + 0.4) / 3 > 0.5
ORACLES["forest_votes"] = _VOTERS + """
SELECT sampling_id, y::INT AS label, (x1 + x2 + x3 >= 2)::INT AS by_votes, x1::INT AS by_average FROM x"""
ORACLES["tune_trees"] = _VOTERS + f""",
t AS (SELECT y = x2 AS one, y = (x2 + x3 > 1)::INT AS two, y = (x1 + x2 + x3 > 1)::INT AS three
      FROM x WHERE {_u('event_id', 'split')} >= 0.7),
a AS (SELECT unnest([1, 2, 3]) AS trial, unnest([avg(one::INT), avg(two::INT), avg(three::INT)]) AS accuracy FROM t)
SELECT 'numTrees' AS search, trial::INT AS trial, 'numTrees=' || trial AS params, accuracy FROM a
UNION ALL SELECT 'numTrees:best', 0, 'continuous=3 categorical=0 trees=' || arg_min(trial, (-accuracy, trial)) || ' depth=1',
  max(accuracy) FROM a"""
ORACLES["oversample_poisson"] = OBS_CTE + _SIZES + f""",
c AS (SELECT sum(exp(k * ln(r) - r - lgamma(k + 1))) OVER (ORDER BY k) AS reached
      FROM (SELECT greatest(n0, n1) / least(n0, n1) AS r FROM sizes), (SELECT unnest(range(80)) AS k)),
l AS (SELECT event_id, (label_count > 0)::INT AS label, {_u('event_id', 'sample')} AS u,
             (label_count > 0) = (n0 > n1) AND n0 <> n1 AS few
      FROM obs, sizes WHERE label_count IS NOT NULL),
d AS (SELECT event_id, label, count(reached) AS n FROM l JOIN c ON few AND reached <= u GROUP BY ALL
      UNION ALL SELECT event_id, label, 1 FROM l WHERE NOT few)
SELECT event_id, label, unnest(range(n))::INT AS copy FROM d"""
ORACLES["wide_measures"] = """
WITH e AS (SELECT event_id, user_id, value,
             CASE WHEN event_id % 17 = 0 THEN NULL ELSE (event_id % 7)::DOUBLE END AS y FROM events),
c AS (SELECT i, y, CASE WHEN (event_id + i) % 97 = 0 THEN NULL
                        WHEN (event_id * 7 + user_id + i) % 10 = 0 THEN value * (i % 7 + 1) + i ELSE 0.0e0 END AS x
      FROM e, (SELECT unnest(range(420)) AS i)),
m AS (SELECT avg(y) AS ybar FROM e),
s AS (SELECT i, count(x) AS n, avg(x) AS mean, avg(x) FILTER (y IS NOT NULL) AS mx,
             var_pop(x) FILTER (y IS NOT NULL) AS vx, covar_pop(x, y) AS cxy,
             avg(y) FILTER (x IS NOT NULL) AS my, var_pop(y) FILTER (x IS NOT NULL) AS vy
      FROM c GROUP BY i)
SELECT 'w' || i AS feature, n, round(mean, 6) AS mean,
       round(abs((cxy + mx * (my - ybar)) / (sqrt(vx) * sqrt(vy + (my - ybar) * (my + ybar)))), 6) AS score
FROM s, m"""
ORACLES["jobs_train_predict"] = """
SELECT concat('S', event_id::VARCHAR) AS sampling_id, (hour(ts) >= 12)::INT AS prediction,
  row_number() OVER (ORDER BY event_id) - 1 AS position FROM events"""
ORACLES["job_report"] = """
SELECT part, 'continuous=14 categorical=0 trees=50 depth=10' AS name, 1.0e0 AS value
FROM (VALUES ('final'), ('final:natural')) t(part)
UNION ALL
SELECT 'feature', name, place::DOUBLE FROM (VALUES """ + ", ".join(
    f"('{name}', {i})" for i, name in enumerate(CHECKLIST_DEFAULT_FEATURES)) + ") t(name, place)"

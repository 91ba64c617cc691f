"""Raw text rows -> typed wide form, long forms, category dictionaries.

Wide form: one nullable double per continuous or id feature (NULL =
missing, 0.0 = absent), one nullable string per discrete feature, the key
as text. Excluded columns are not selected, so a columnar or CSV source
never decodes them.

Long forms come from ``unpivot`` (one Expand operator, no shuffle). Every
measure aggregates a long form by ``feature`` with partial aggregation, so a
table of any width is reduced map-side to one row per feature per task
before the only shuffle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldnotes.functions.cells import (category_cell_sql, id_cell_sql, numeric_cell_sql,
                                        quote_ident, sql_str)
from fieldnotes.spec import FeatureSpec


# Widest group of columns one unpivot (Expand) takes. Above ~100 input
# fields Spark turns whole-stage code generation off, and very wide Expand
# code is too large for the JIT; a union of narrow unpivots keeps every
# stage compiled (400 columns x 600k rows: 18.5 s as one unpivot, 6.3 s as
# 40-column slices, local[8]). Each slice scans only its own columns of a
# columnar source.
SLICE_WIDTH = 40


def unpivot_sliced(base: DataFrame, ids: list[str], feats: list[str], name: str,
                   value: str, keep=None, width: int = SLICE_WIDTH) -> DataFrame:
    """``unpivot`` in column groups of ``width``, united; ``keep`` is a
    row filter on the result (pushed into every group by Catalyst).

    Several groups are written as one SQL statement (``UNION ALL`` of
    ``UNPIVOT`` branches over a temporary view), so the whole union is
    parsed and analysed once; chained ``unionByName`` calls re-analyse the
    growing plan each time, which costs minutes at 1,657 columns.
    """
    step = max(1, width)
    groups = [feats[i:i + step] for i in range(0, len(feats), step)]
    if len(groups) == 1:
        out = base.select(*ids, *feats).unpivot(ids, feats, name, value)
    else:
        spark = base.sparkSession
        view = f"__unpivot_{uuid.uuid4().hex}"
        base.createOrReplaceTempView(view)
        q = quote_ident
        id_sql = "".join(f"{q(i)}, " for i in ids)
        branches = [
            f"SELECT {id_sql}{q(name)}, {q(value)} FROM "
            f"(SELECT {id_sql}{', '.join(map(q, g))} FROM {view}) "
            f"UNPIVOT INCLUDE NULLS ({q(value)} FOR {q(name)} IN ({', '.join(map(q, g))}))"
            for g in groups]
        try:
            out = spark.sql(" UNION ALL ".join(branches))
        finally:
            spark.catalog.dropTempView(view)
    return out.filter(keep) if keep is not None else out


def _double_casts(feats: list[str]) -> list[str]:
    return [f"CAST({quote_ident(c)} AS DOUBLE) AS {quote_ident(c)}" for c in feats]


def id_output_name(spec: FeatureSpec, c: str) -> str:
    """Name of a parsed id column (the key keeps its own name as text)."""
    return f"{c}_num" if c == spec.key else c


def parse(raw: DataFrame, spec: FeatureSpec, on_error: str = "raise",
          strict_empty: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Typed wide form of a raw text table, in file column order; ``keep``
    names further columns of ``raw`` to pass through.

    One ``selectExpr`` of SQL texts: the projection of any width is built
    and parsed in the JVM with one call.
    """
    q = quote_ident
    exprs = [q(c) for c in spec.carry]
    if spec.key is not None:
        exprs.append(q(spec.key))
    for c in spec.columns:
        if spec.is_excluded(c) or spec.is_carried(c):
            continue
        if spec.is_id(c):
            exprs.append(f"{id_cell_sql(c, spec.missing_token, on_error)} AS "
                         f"{q(id_output_name(spec, c))}")
        elif spec.is_discrete(c):
            exprs.append(f"{category_cell_sql(c, spec.missing_token)} AS {q(c)}")
        elif spec.is_continuous(c):
            exprs.append(f"{numeric_cell_sql(c, spec.missing_token, spec.null_token, spec.null_token_value, on_error, strict_empty)} AS {q(c)}")  # noqa: E501
    return raw.selectExpr(*exprs, *map(q, keep or []))


def bad_cell_counts(raw: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Per numeric or id column, the number of cells that do not parse.

    One pass and one single-row aggregate (partial sums per task). Use it
    with ``parse(on_error='null')`` to count instead of failing.
    """
    tolerant = {}
    for c in spec.columns:
        if spec.is_id(c):
            tolerant[c] = id_cell_sql(c, spec.missing_token, "null")
        elif spec.is_continuous(c):
            tolerant[c] = numeric_cell_sql(c, spec.missing_token, spec.null_token,
                                           spec.null_token_value, "null")
    miss = sql_str(spec.missing_token)
    sums = [f"sum(CAST(({e}) IS NULL AND {quote_ident(c)} <> {miss} AS BIGINT)) AS "
            f"{quote_ident(c)}" for c, e in tolerant.items()]
    return raw.selectExpr(*sums)


def numeric_features(spec: FeatureSpec, include_label: bool = True,
                     include_ids: bool = False) -> list[str]:
    cols = [c for c in spec.continuous if include_label or c != spec.label]
    if include_ids:
        cols = [id_output_name(spec, c) for c in spec.id_features] + cols
    return cols


def long_form(wide: DataFrame, spec: FeatureSpec, row_id: str,
              features: list[str] | None = None) -> DataFrame:
    """Sparse long form ``row_id, feature, value``: non-zero and missing
    cells only (absent = zero is not stored)."""
    feats = features if features is not None else numeric_features(spec)
    return unpivot_sliced(wide, [row_id], feats, "feature", "value",
                          F.col("value").isNull() | (F.col("value") != 0))


def numeric_cells(wide: DataFrame, spec: FeatureSpec | None = None, row_id: str | None = None,
                  features: list[str] | None = None, with_label: bool = True,
                  label: str | None = None) -> DataFrame:
    """Zero-filled cells ``[row_id,] feature, value[, label_count]``;
    missing cells dropped. The label is a feature here too.

    Works on any typed wide table: without a spec, give ``features`` (and
    ``label`` or ``with_label=False``).
    """
    feats = features if features is not None else numeric_features(spec)
    lab = label if label is not None else (spec.label if spec is not None else None)
    with_label = with_label and lab is not None
    ids = [row_id] if row_id else []
    casts = _double_casts(feats)
    if with_label:
        # the label is kept under an internal name, as it is a feature too
        base = wide.selectExpr(*map(quote_ident, ids),
                               f"CAST({quote_ident(lab)} AS DOUBLE) AS __y", *casts)
        ids = ids + ["__y"]
    else:
        base = wide.selectExpr(*map(quote_ident, ids), *casts)
    return (unpivot_sliced(base, ids, feats, "feature", "value", F.col("value").isNotNull())
            .select(*([row_id] if row_id else []), "feature", "value",
                    *([F.col("__y").alias("label_count")] if with_label else [])))


def category_cells(wide: DataFrame, spec: FeatureSpec | None = None,
                   features: list[str] | None = None, label: str | None = None,
                   row_id: str | None = None) -> DataFrame:
    """Long form of discrete cells ``[row_id,] feature, category
    [, label_count]``; missing cells dropped."""
    feats = features if features is not None else list(spec.discrete_features)
    lab = label if label is not None else (spec.label if spec is not None else None)
    ids = [row_id] if row_id else []
    cols = [quote_ident(i) for i in ids]
    if lab:
        cols.append(f"CAST({quote_ident(lab)} AS DOUBLE) AS __y")
    base = wide.selectExpr(*cols, *[f"CAST({quote_ident(c)} AS STRING) AS {quote_ident(c)}"
                                    for c in feats])
    keep = ids + (["__y"] if lab else [])
    return (unpivot_sliced(base, keep, feats, "feature", "category",
                           F.col("category").isNotNull())
            .select(*ids, "feature", "category",
                    *([F.col("__y").alias("label_count")] if lab else [])))


def category_values(wide: DataFrame, features: list[str]) -> DataFrame:
    """Distinct ``feature, category`` pairs (missing left out). Partial
    aggregation keeps the shuffle at one row per pair per task."""
    return category_cells(wide, features=features).distinct()


def category_codes(values: DataFrame, method: str = "sorted") -> DataFrame:
    """Dense codes 0..k-1 per feature, in alphabetical order of the name.

    ``window``: a window partitioned by feature; it holds one feature's
    distinct names, so its size is the dictionary size, not the row count.
    ``sorted``: for very large dictionaries -- a global sort by (feature,
    name) gives distributed positions (``checks.with_position``), and each
    feature's first position (one row per feature, broadcast) is
    subtracted; no task holds a whole dictionary.
    """
    if method == "window":
        w = Window.partitionBy("feature").orderBy("category")
        return values.withColumn("code", (F.row_number().over(w) - 1).cast("int"))
    if method != "sorted":
        raise ValueError("method must be 'window' or 'sorted'")
    from fieldnotes.operators.checks import with_position
    pos = with_position(values.select("feature", "category"), ["feature", "category"])
    starts = pos.groupBy("feature").agg(F.min("position").alias("__start"))
    return (pos.join(F.broadcast(starts), "feature")
            .select("feature", "category",
                    (F.col("position") - F.col("__start")).cast("int").alias("code")))


def encode_categories(wide: DataFrame, dictionary: DataFrame, features: list[str],
                      suffix: str = "_code") -> DataFrame:
    """Add ``<feature>_code`` per discrete feature by a lookup join.

    The dictionary side is an aggregate; AQE measures it at run time and
    turns the join into a broadcast hash join when it is below
    ``spark.sql.adaptive.autoBroadcastJoinThreshold`` -- a checked size --
    and keeps a shuffled join otherwise. Missing stays NULL; a name not in
    the dictionary gets NULL too (``StringIndexer`` in the model pipeline
    gives both their own code instead).
    """
    if len(features) > 1:
        from fieldnotes.operators.search import materialize
        dictionary = materialize(dictionary)  # else each join computes it anew
    out = wide
    for c in features:
        d = (dictionary.filter(F.col("feature") == c)
             .select(F.col("category").alias(f"__cat_{c}"), F.col("code").alias(c + suffix)))
        out = out.join(d, out[c] == d[f"__cat_{c}"], "left").drop(f"__cat_{c}")
    return out


def partition_by_feature(cells: DataFrame, partitions: int | None = None) -> DataFrame:
    """Hash-partition a long form by feature, so several measures of one
    feature read one partition. This shuffles every cell; the measures do
    not need it (their partial aggregation ships one row per feature per
    task), so use it only when many per-feature passes follow."""
    return (cells.repartition(partitions, "feature") if partitions
            else cells.repartition("feature"))


ROW_MARKER = "__row"


def sparse_cells(wide: DataFrame, spec: FeatureSpec | None = None,
                 features: list[str] | None = None, label: str | None = None) -> DataFrame:
    """Sparse cells ``feature, value[, label_count]``: non-zero and missing
    cells only, plus one marker cell per row (feature ``__row``, value
    1.0) that carries the row's label, so row totals come from the same
    pass. Zeros never reach an aggregate: with mostly-zero features this
    is a fraction of the zero-filled cells."""
    feats = features if features is not None else numeric_features(spec)
    lab = label if label is not None else (spec.label if spec is not None else None)
    keep = []
    cols = [f"CAST(1.0 AS DOUBLE) AS {ROW_MARKER}"] + _double_casts(feats)
    if lab is not None:
        cols.insert(0, f"CAST({quote_ident(lab)} AS DOUBLE) AS __y")
        keep = ["__y"]
    base = wide.selectExpr(*cols)
    out = unpivot_sliced(base, keep, [ROW_MARKER] + feats, "feature", "value",
                         F.col("value").isNull() | (F.col("value") != 0))
    return out.select("feature", "value",
                      *([F.col("__y").alias("label_count")] if lab is not None else []))

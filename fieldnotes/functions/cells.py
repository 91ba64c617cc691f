"""Column expressions for reading one text cell by its role.

All of these are built-in Catalyst expressions (no Python UDF), so a parse
of any width stays inside the JVM and whole-stage code generation.

Missing is SQL NULL everywhere -- never NaN: in Spark SQL ``NaN > 0`` and
``NaN = NaN`` are true, which would turn a missing label into a positive.
A text ``NaN`` therefore reads as missing too.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ON_ERROR = ("raise", "null")
_INF = float("inf")

# The cell rules are written as SQL text: a parse of a wide table is then
# one ``selectExpr`` call (parsed in the JVM) instead of tens of Python ->
# JVM calls per column, which cost over a minute at 1,657 columns.


def quote_ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_str(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_double(v: float) -> str:
    v = float(v)
    if v != v or v in (_INF, -_INF):
        return f"CAST({sql_str({_INF: 'Infinity', -_INF: '-Infinity'}.get(v, 'NaN'))} AS DOUBLE)"
    return f"CAST({v!r} AS DOUBLE)"


_NULL = "CAST(NULL AS DOUBLE)"


def _bad_sql(kind: str, name: str, c: str, on_error: str) -> str:
    if on_error == "raise":
        msg = sql_str(f"bad {kind} cell in column {name}: '")
        return f"CAST(raise_error(concat({msg}, {c}, {sql_str(chr(39))})) AS DOUBLE)"
    if on_error == "null":
        return _NULL
    raise ValueError(f"on_error must be one of {ON_ERROR}")


def _numeric_text(token: str) -> bool:
    try:
        float(token)
        return True
    except ValueError:
        return False


def numeric_cell_sql(name: str, missing_token: str = "?", null_token: str = "X",
                     null_token_value: float = 0.0, on_error: str = "raise",
                     strict_empty: bool = False) -> str:
    """SQL text of ``numeric_cell`` (see there)."""
    c = quote_ident(name)
    parsed = f"try_cast({c} AS DOUBLE)"
    number = f"WHEN {parsed} IS NOT NULL THEN nanvl({parsed}, {_NULL})"
    tokens = (f"WHEN {c} = {sql_str(missing_token)} THEN {_NULL} "
              f"WHEN {c} = {sql_str(null_token)} THEN {sql_double(null_token_value)}")
    absent = f"WHEN {c} IS NULL THEN {sql_double(0.0)}"
    empty = _bad_sql("empty", name, c, "raise") if strict_empty else sql_double(0.0)
    if _numeric_text(missing_token) or _numeric_text(null_token):
        head = f"{absent} {tokens} {number}"
    else:
        head = f"{number} {absent} {tokens}"
    return (f"CASE {head} WHEN trim({c}) = '' THEN {empty} "
            f"ELSE {_bad_sql('numeric', name, c, on_error)} END")


def numeric_cell(name: str, missing_token: str = "?", null_token: str = "X",
                 null_token_value: float = 0.0, on_error: str = "raise",
                 strict_empty: bool = False) -> Column:
    """Continuous cell: ``?`` -> NULL, ``X`` -> ``null_token_value``,
    absent (short row) -> 0.0, else the number.

    The reader's NULL (absent tail of a short row) is 0. An empty cell
    inside a row also reads as 0.0, or is an error with ``strict_empty``
    (the reader must then keep empty text apart from NULL, see
    ``sources.csv.read_observations``).

    The common case -- a number -- is decided first by one ``try_cast``
    (``nanvl`` maps a text NaN to NULL); the token and empty tests run only
    for cells that do not parse. Tokens that are themselves numbers are
    tested first instead, so they keep their meaning.
    """
    return F.expr(numeric_cell_sql(name, missing_token, null_token, null_token_value,
                                   on_error, strict_empty))


def id_number_sql(text_sql: str) -> str:
    digits = f"regexp_extract({text_sql}, '([0-9]+)', 1)"
    return f"CASE WHEN {digits} <> '' THEN try_cast({digits} AS DOUBLE) END"


def id_number(text: Column) -> Column:
    """First run of ASCII digits of a text, as a double (NULL if none)."""
    digits = F.regexp_extract(text, r"([0-9]+)", 1)
    return F.when(digits != "", digits.try_cast("double"))


def id_cell_sql(name: str, missing_token: str = "?", on_error: str = "raise") -> str:
    c = quote_ident(name)
    num = id_number_sql(c)
    return (f"CASE WHEN {c} IS NULL OR {c} = '' THEN {sql_double(0.0)} "
            f"WHEN {c} = {sql_str(missing_token)} THEN {_NULL} "
            f"WHEN {num} IS NOT NULL THEN {num} "
            f"ELSE {_bad_sql('id', name, c, on_error)} END")


def id_cell(name: str, missing_token: str = "?", on_error: str = "raise") -> Column:
    """Id cell: ``?`` -> NULL, absent -> 0.0, else the first digits."""
    return F.expr(id_cell_sql(name, missing_token, on_error))


def category_cell_sql(name: str, missing_token: str = "?") -> str:
    c = quote_ident(name)
    return (f"CASE WHEN {c} IS NOT NULL AND {c} <> '' AND {c} <> {sql_str(missing_token)} "
            f"THEN {c} END")


def category_cell(name: str, missing_token: str = "?") -> Column:
    """Discrete cell: category text; ``?`` and absent cells are NULL.

    The null token is an ordinary category name here (it is only special
    for numbers).
    """
    return F.expr(category_cell_sql(name, missing_token))


def binary_label(label_count: Column | str) -> Column:
    """1.0 when the count is positive, 0.0 when zero, NULL when missing."""
    y = F.col(label_count) if isinstance(label_count, str) else label_count
    return F.when(y.isNotNull(), (y > 0).cast("double"))


def finite_or_zero(x: Column) -> Column:
    """NULL, NaN or infinite -> 0.0 (a score that cannot be computed)."""
    return (F.when(x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(_INF)), F.lit(0.0))
            .otherwise(x))


def rounded(x: Column, places: int = 6) -> Column:
    return F.round(x, places)

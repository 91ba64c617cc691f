"""Repeatable per-row uniform numbers from a key.

``u(key)`` takes the first 52 bits of the MD5 of the key's text and maps
them to [0, 1). The same key gives the same number on every run, on every
partitioning, after any task retry, and in other engines (DuckDB:
``('0x' || substr(md5(k::varchar), 1, 13))::bigint / 4503599627370496.0``), so
splits and samples are reproducible and can be checked by SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX = 13  # 52 bits: as many as a double holds exactly
_ALL = float(1 << 52)


def uniform(key: Column | str, salt: str | None = None) -> Column:
    """Uniform number in [0, 1) from a key column (optionally salted, so
    independent draws can be made from one key)."""
    k = F.col(key) if isinstance(key, str) else key
    # a NULL key has no draw: rows would vanish or all fall on one side
    text = F.coalesce(k.cast("string"), F.raise_error(F.lit("NULL key in a repeatable draw")).cast("string"))
    if salt:
        text = F.concat(text, F.lit(f"#{salt}"))
    return F.conv(F.substring(F.md5(text), 1, _HEX), 16, 10).cast("bigint") / F.lit(_ALL)


def uniform_sql(key_sql: str) -> str:
    """The same number as DuckDB SQL text (for oracles)."""
    return (f"(('0x' || substr(md5(CAST({key_sql} AS VARCHAR)), 1, {_HEX}))::BIGINT"
            f" / {_ALL})")

"""Deterministic uniform draws.

``u = int(md5(seed|k1|k2|...|salt)[0:8], 16) / 2**32`` — a pure function of the row's
keys, so a retried or re-partitioned task draws the same numbers (``rand()`` does not)
and an SQL engine with ``md5`` reproduces them bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _key(seed: str, parts, salt: str) -> Column:
    cols = [F.lit(str(seed))]
    for p in parts:
        c = F.col(p) if isinstance(p, str) else p
        cols.append(c.cast("string"))
    cols.append(F.lit(salt))
    return F.concat_ws("|", *cols)


def uniform(parts, salt: str, seed: str = "42") -> Column:
    """Uniform double in [0, 1) from the md5 of ``seed|parts...|salt``."""
    hex8 = F.substring(F.md5(_key(seed, parts, salt)), 1, 8)
    return F.conv(hex8, 16, 10).cast("bigint") / F.lit(TWO_32)


def pick_index(u: Column, n) -> Column:
    """0-based index ``floor(u * n)``; ``n`` may be a column or an int."""
    n_col = n if isinstance(n, Column) else F.lit(n)
    return F.floor(u * n_col).cast("int")


def randint(u: Column, lo, hi) -> Column:
    """Inclusive integer in [lo, hi] (``lo + floor(u * (hi - lo + 1))``)."""
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    return (lo_c + F.floor(u * (hi_c - lo_c + 1))).cast("int")


def sql_uniform(parts_sql: list[str], salt: str, seed: str = "42") -> str:
    """The DuckDB twin of :func:`uniform` (used by the SQL oracles)."""
    args = ", ".join([f"'{seed}'"] + [f"CAST({p} AS VARCHAR)" for p in parts_sql] + [f"'{salt}'"])
    return f"(CAST(('0x' || substr(md5(concat_ws('|', {args})), 1, 8)) AS BIGINT) / 4294967296.0)"

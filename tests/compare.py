"""Result comparison between a Spark frame and the oracle engine."""

from __future__ import annotations

import math
from collections import Counter

TABLES = ["part", "orders", "lineitem"]


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return repr(value)
    return value


def difference(df, con, sql: str, limit: int = 3) -> str | None:
    """None when both give the same columns and the same bag of rows."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(df.columns)} / {sorted(names)}"
    order = sorted(names)
    theirs = Counter(
        tuple(_plain(row[names.index(c)]) for c in order) for row in cursor.fetchall()
    )
    mine = Counter(tuple(_plain(row[c]) for c in order) for row in df.collect())
    if mine == theirs:
        return None
    return (
        f"{order}: {sum(mine.values())} / {sum(theirs.values())} rows; "
        f"only ours {list((mine - theirs).items())[:limit]}; "
        f"only theirs {list((theirs - mine).items())[:limit]}"
    )

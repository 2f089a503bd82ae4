"""Quantile edges without ranking keys: a mergeable sketch brackets every place that is asked
for, and one counting pass finds the values inside the brackets."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Distinct values of all brackets together that are counted one by one.
MOST_VALUES = 100_000
#: First accuracy of the sketch, and the last one before values are counted however many.
ACCURACY, LAST_ACCURACY = 1_000, 1_000_000


def values_at(rows: DataFrame, column: str, places: list[int], n: int) -> dict[int, object]:
    """The values at the sorted positions ``places`` (from 0) of the ``n`` rows that have one.

    Three aggregates: the sketch gives a bracket around each place; exact counts below and up
    to it prove that the place is inside; the rows of the brackets are counted by value. A
    bracket that misses its place, or brackets with too many values, make the sketch finer.
    Rows are never sorted, and what reaches the driver is bounded by ``MOST_VALUES``.
    """
    value, accuracy = F.col(column), ACCURACY
    while True:
        margin = Fraction(2 * n, accuracy)
        shares = [min(max((p + s * margin) / max(n - 1, 1), 0), 1) for p in places for s in (-1, 1)]
        edges = rows.agg(F.percentile_approx(value, [float(x) for x in shares], accuracy).alias("q")).first()["q"]
        brackets = dict(zip(places, zip(edges[::2], edges[1::2], strict=True), strict=True))
        inside = F.lit(False)
        for low, high in set(brackets.values()):
            inside = inside | value.between(low, high)
        counts = rows.agg(
            F.approx_count_distinct(F.when(inside, value)).alias("values"),
            *(F.count_if(value < brackets[p][0]).alias(f"below{p}") for p in places),
            *(F.count_if(value <= brackets[p][1]).alias(f"upto{p}") for p in places),
        ).first()
        proven = all(counts[f"below{p}"] <= p < counts[f"upto{p}"] for p in places)
        if proven and (counts["values"] <= MOST_VALUES or accuracy >= LAST_ACCURACY):
            break
        accuracy *= 10
    tally = rows.filter(inside).groupBy(value.alias("v")).agg(F.count(F.lit(1)).alias("n")).collect()
    found: dict[int, object] = {}
    for p, (low, high) in brackets.items():
        at = counts[f"below{p}"]
        for v, k in sorted((r["v"], r["n"]) for r in tally if low <= r["v"] <= high):
            at += k
            if at > p:
                found[p] = v
                break
    return found


def quantile_edges(rows: DataFrame, column: str, parts: list[Fraction]) -> list[float]:
    """The quantiles ``parts`` of a column, interpolated linearly between neighbours; rows
    without a value do not count. No rows give no edges."""
    n = rows.agg(F.count(column)).first()[0]
    if not n:
        return []
    where = [part * (n - 1) for part in parts]
    places = sorted({int(w) for w in where} | {-int(-w // 1) for w in where})
    known = {p: float(v) for p, v in values_at(rows, column, places, n).items()}
    edges = []
    for w in where:
        low, high = known[int(w)], known[-int(-w // 1)]
        edges.append(low + (high - low) * float(w - int(w)))
    return edges


def tier(value: Column, edges: list[float], low: float) -> Column:
    """In which part between the edges a value lies: parts are closed on the right, and edges
    that coincide, also with the lowest value, collapse."""
    distinct = sorted({edge for edge in edges if edge > low})
    total = F.lit(0)
    for edge in distinct:
        total = total + (value > edge).cast("int")
    return total


def price_tiers(rows: DataFrame, column: str = "price_usd") -> DataFrame:
    """``rows`` with ``price_tier``, the quarter of all rows that their price lies in."""
    edges = quantile_edges(rows, column, [Fraction(q, 4) for q in (1, 2, 3)])
    lowest = rows.agg(F.min(column).cast("double")).first()[0]
    return rows.withColumn("price_tier", tier(F.col(column).cast("double"), edges, lowest or 0.0))

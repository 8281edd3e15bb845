"""Identical-row collapsing with copy counts.

Feeds may carry many identical rows (re-sent files, double loads), and the
reconciliation keeps their effect: each copy multiplies the contract's months
and doubles sums and counts.  Instead of carrying every copy through the
shuffles and the month explode, each feed is collapsed to distinct rows with a
copy count (a group-by with map-side partial counts, so a hot group of copies
shrinks before it is shuffled).  Joined rows multiply their counts; sums and
counts downstream are weighted by them, which is exactly what summing over the
copies would give.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COPIES = "_copies"


def collapse_copies(df: DataFrame, name: str, cols: list[str] | None = None) -> DataFrame:
    """Distinct rows of ``cols`` (default: all) with their copy count in ``name``."""
    return df.groupBy(*(cols or df.columns)).agg(F.count(F.lit(1)).alias(name))


def combined_copies(names: list[str]) -> Column:
    """Product of per-feed copy counts; a feed that did not match counts once."""
    return reduce(lambda a, b: a * b, [F.coalesce(F.col(n), F.lit(1)).cast("long") for n in names])

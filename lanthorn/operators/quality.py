"""Quality gates as data: one row per rule with its number of violations.

Each rule is an aggregate over its table (or an anti join), so an audit is
a handful of scans with map-side partial aggregation; ``enforce`` turns a
non-zero count into an error for pipelines that must stop.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _as_row(name: str, agg_df: DataFrame) -> DataFrame:
    return agg_df.select(F.lit(name).alias("rule"), F.col("violations").cast("long"))


def expect_unique(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows beyond the first per key (0 when the key is unique)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return _as_row(name, per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations")))


def expect_not_null(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    return _as_row(name, df.agg(F.count_if(any_null).alias("violations")))


def expect_between(df: DataFrame, col: str, low, high, name: str) -> DataFrame:
    bad = ~F.coalesce(F.col(col).between(low, high), F.lit(True))
    return _as_row(name, df.agg(F.count_if(bad).alias("violations")))


def expect_in(df: DataFrame, col: str, allowed: Sequence, name: str) -> DataFrame:
    bad = ~F.coalesce(F.col(col).isin(*allowed), F.lit(True))
    return _as_row(name, df.agg(F.count_if(bad).alias("violations")))


def expect_fk(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str,
              name: str) -> DataFrame:
    keys = parent.select(F.col(parent_key).alias("__pk")).distinct()
    missing = child.join(keys, child[child_key] == F.col("__pk"), "left_anti")
    return _as_row(name, missing.agg(F.count(F.lit(1)).alias("violations")))


def expect_min_rows(df: DataFrame, minimum: int, name: str) -> DataFrame:
    """Shortfall below ``minimum`` rows (0 when met)."""
    return _as_row(name, df.agg(F.greatest(F.lit(minimum) - F.count(F.lit(1)), F.lit(0))
                                .alias("violations")))


def expect_min_distinct(df: DataFrame, col: str, minimum: int, name: str) -> DataFrame:
    return _as_row(name, df.agg(F.greatest(F.lit(minimum) - F.count_distinct(col), F.lit(0))
                                .alias("violations")))


def expect_nonempty(df: DataFrame, name: str) -> DataFrame:
    """1 when the frame has no row; reads at most one row per partition."""
    probe = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
    return _as_row(name, probe.select((1 - F.col("n")).alias("violations")))


def expect_no_nulls_left(df: DataFrame, name: str) -> DataFrame:
    return expect_not_null(df, df.columns, name)


def audit(rules: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), rules)


class QualityError(AssertionError):
    pass


def enforce(report: DataFrame) -> None:
    """Raise when any rule has violations (collects one row per rule)."""
    bad = [(r["rule"], r["violations"]) for r in report.filter("violations > 0").collect()]
    if bad:
        raise QualityError("; ".join(f"{n}: {v}" for n, v in bad))

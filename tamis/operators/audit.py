"""Counts that tell the state of tables: coverage, completeness, roll-ups of usage. Each is one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counters(df: DataFrame, tests: dict[str, Column], distinct: dict[str, Column] | None = None, by: list[str] | None = None) -> DataFrame:
    """One row (per group): rows, how many rows each test holds for (null: not), distinct non-null values of columns."""
    aggs = [F.count("*").alias("rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in tests.items()], *[F.count_distinct(c).alias(k) for k, c in (distinct or {}).items()]]
    return df.groupBy(*(by or [])).agg(*aggs)


def pages_complete(df: DataFrame, source: list[str], page: str, item: str, total: str) -> DataFrame:
    """source, items, pages, complete: distinct items equal the one total reported and the pages run from 1 without a gap."""
    g = df.groupBy(*source).agg(F.count_distinct(item).alias("items"), F.count_distinct(page).alias("pages"), F.max(page).alias("_last"), F.min(page).alias("_first"), F.min(total).alias("_t0"), F.max(total).alias("_t1"))
    ok = (F.col("items") == F.col("_t0")) & (F.col("_t0") == F.col("_t1")) & (F.col("_first") == 1) & (F.col("_last") == F.col("pages"))
    return g.select(*source, "items", "pages", F.coalesce(ok, F.lit(False)).alias("complete"))


def quantiles(df: DataFrame, by: list[str], value: str, at: dict[str, float], exact: bool = True) -> DataFrame:
    """by, and a column for each quantile. Exact ones interpolate; the others are sketched, for groups of any size."""
    f = (lambda q: F.percentile(value, F.lit(q))) if exact else (lambda q: F.percentile_approx(value, q, 10_000).cast("double"))
    return df.groupBy(*by).agg(*[f(q).alias(k) for k, q in at.items()])


def shared(df: DataFrame, key: str, least: int = 2) -> DataFrame:
    """key, n of the non-null keys that at least ``least`` rows share."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def usage(df: DataFrame, by: list[str], sums: list[str], expected: str, reported: str) -> DataFrame:
    """by, sums of counters (null as 0), and unreported: expected less reported, never below 0."""
    return df.groupBy(*by).agg(*[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in sums], F.greatest(F.lit(0), F.sum(F.coalesce(expected, F.lit(0))) - F.sum(F.coalesce(reported, F.lit(0)))).alias("unreported"))


def token_cost(items: Column, tokens_in: float, tokens_out: float, price_in: float, price_out: float, margin: float = 1.25) -> Column:
    """Estimated cost of a number of model calls, prices per million tokens, to four places; null below 0."""
    return F.when(items >= 0, F.round(items * (tokens_in * price_in + tokens_out * price_out) / 1e6 * margin, 4))

"""Keyed merges with guards against late data, and the changes they make.

Parquet tables have no MERGE, so a merge is a full outer join on the key with one expression per column; the result is written
to a new version of the table (``sources.files.write_version``). One batch may hold several observations of a key: they are
brought to one row first, the latest that isn't older than what is stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tamis.functions.keys import any_distinct
from tamis.operators.select import winner


def is_stale(observed: Column, *last: Column) -> Column:
    """Whether an observation is older than the last known time; never null: without a known time nothing is stale."""
    known = F.greatest(*last) if len(last) > 1 else last[0]
    return F.coalesce(observed < known, F.lit(False))


def accepted_in_order(df: DataFrame, keys: list[str], arrival: str, time: str) -> DataFrame:
    """``df`` with ``stale``: rows whose time lies before that of an earlier arrival of the same key.

    A stale row can't raise the running maximum, so the maximum over all earlier rows is that over the accepted ones.
    """
    w = Window.partitionBy(*keys).orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("stale", F.coalesce(F.col(time) < F.max(time).over(w), F.lit(False)))


def merge(stored: DataFrame, batch: DataFrame, keys: list[str], time: str, compare: list[str], fill: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(new table, events) of a batch merged into a table with the same columns.

    Of each key the batch's latest row counts; older than the stored one it is stale and ignored. ``fill`` columns keep the
    stored value where the batch has null. An event (keys, change, observed_at) is made for new keys (insert) and for keys that
    differ in a ``compare`` column (update); the same data seen again only moves the time on. Stored keys that the batch doesn't
    name stay. Null keys equal null keys.
    """
    fill = fill or []
    others = [c for c in stored.columns if c not in keys]
    one = winner(batch.select(*stored.columns), keys, [F.col(time)])
    s = stored.select(*[F.col(k).alias(f"s_{k}") for k in keys], F.struct(*others).alias("s"), F.lit(True).alias("has_s"))
    b = one.select(*[F.col(k).alias(f"b_{k}") for k in keys], F.struct(*others).alias("b"), F.lit(True).alias("has_b"))
    j = s.join(b, [F.col(f"s_{k}").eqNullSafe(F.col(f"b_{k}")) for k in keys], "full")
    take = F.col("has_b").isNotNull() & ~(F.col("has_s").isNotNull() & is_stale(F.col("b")[time], F.col("s")[time]))
    value = lambda c: F.when(take, F.coalesce(F.col("b")[c], F.col("s")[c]) if c in fill else F.col("b")[c]).otherwise(F.col("s")[c])
    key = [F.when(F.col("has_s").isNotNull(), F.col(f"s_{k}")).otherwise(F.col(f"b_{k}")).alias(k) for k in keys]
    changed = any_distinct([(value(c), F.col("s")[c]) for c in compare])
    merged = j.select(*key, *[value(c).alias(c) for c in others], F.when(F.col("has_s").isNull(), "insert").when(take & changed, "update").alias("change"), F.when(take, F.col("b")[time]).alias("observed_at"))
    return merged.select(*stored.columns), merged.filter("change is not null").select(*keys, "change", "observed_at")


def retire_unseen(stored: DataFrame, seen: DataFrame, keys: list[str], time: str, observed_at: Column, state: str = "state", removed: str = "removed") -> DataFrame:
    """``stored`` after a complete inventory: keys it doesn't name are removed, unless they were checked later than it."""
    s = seen.select(*keys).distinct().withColumn("_seen", F.lit(True))
    gone = F.col("_seen").isNull() & ~is_stale(observed_at, F.col(time))
    out = stored.join(s, keys, "left")
    return out.withColumns({state: F.when(gone, removed).otherwise(F.col(state)), time: F.when(gone, observed_at).otherwise(F.col(time))}).select(*stored.columns)


def change_log(df: DataFrame, keys: list[str], order: list[str], compare: list[str]) -> DataFrame:
    """Rows that differ from the one before them in their group, the first one included: what an outbox would have held."""
    w = Window.partitionBy(*keys).orderBy(*order)
    now = F.struct(*compare)
    return df.withColumn("_prev", F.lag(now).over(w)).withColumn("_first", F.row_number().over(w) == 1).filter(F.col("_first") | ~now.eqNullSafe(F.col("_prev"))).drop("_prev", "_first")


def state_of_parts(states: Column) -> Column:
    """in_stock if any part is, sold_out if all are, else unknown; for an aggregation over non-null states."""
    return F.when(F.bool_or(states == "in_stock"), "in_stock").when(F.bool_and(states == "sold_out"), "sold_out").otherwise("unknown")


def tristate(flag: Column) -> Column:
    """True if any flag is true, false if all are false, null otherwise: nulls count as neither."""
    return F.when(F.bool_or(F.coalesce(flag, F.lit(False))), True).when(F.bool_and(F.coalesce(~flag, F.lit(False))), False)


def fill_nulls(target: DataFrame, patch: DataFrame, keys: list[str], columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(target with its nulls filled from the patch, conflicts): values that are there stay, and differing ones are reported."""
    p = patch.select(*keys, *[F.col(c).alias(f"_{c}") for c in columns])
    j = target.join(p, keys, "left")
    filled = j.withColumns({c: F.coalesce(c, f"_{c}") for c in columns}).select(*target.columns)
    clash = F.array_compact(F.array(*[F.when(F.col(c) != F.col(f"_{c}"), F.lit(c)) for c in columns]))
    return filled, j.select(*keys, F.explode(clash).alias("field"))


def guarded_patch(target: DataFrame, patch: DataFrame, key: str, allowed: list[str]) -> DataFrame:
    """key, field, status of each (key, field, before, after) of a patch.

    apply where the stored value is ``before``, applied where it is ``after`` already, drift where it is neither, forbidden for
    fields outside ``allowed``, missing for unknown keys. Nothing should be written if any status is drift, forbidden or missing.
    """
    fields = [c for c in target.columns if c != key]
    long = target.select(key, F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in fields])).alias("x")).select(key, "x.*", F.lit(True).alias("_has"))
    j = patch.join(long, [key, "field"], "left").join(target.select(key, F.lit(True).alias("_key")), key, "left")
    status = (
        F.when(F.col("_key").isNull(), "missing").when(~F.col("field").isin(*allowed), "forbidden")
        .when(F.col("value").eqNullSafe(F.col("before")), "apply").when(F.col("value").eqNullSafe(F.col("after")), "applied").otherwise("drift")
    )
    return j.select(key, "field", status.alias("status"))


def overlay_json(base: Column, new: Column) -> Column:
    """JSON object text with the top-level keys of both, those of ``new`` winning, its nulls included; either may be null.

    Keys come out in binary order. Values are kept as JSON text.
    """
    as_map = lambda c: F.from_json(F.coalesce(c, F.lit("{}")), "map<string,variant>")
    both = F.map_zip_with(as_map(base), as_map(new), lambda k, a, b: F.coalesce(b, a))
    return F.to_json(F.map_from_entries(F.transform(F.array_sort(F.map_keys(both)), lambda k: F.struct(k.alias("key"), F.element_at(both, k).alias("value")))))


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per rule (rule, broken) with the rows that break it; a null condition counts as kept, as in a CHECK."""
    sums = df.agg(*[F.coalesce(F.sum(F.when(~c, 1).otherwise(0)), F.lit(0)).alias(k) for k, c in rules.items()])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.col(k).alias("broken")) for k in rules])).alias("x")).select("x.*")


def duplicate_keys(df: DataFrame, keys: list[str], where: Column | None = None) -> DataFrame:
    """keys, n of the keys that occur more than once among the rows that ``where`` holds for; keys with a null don't count."""
    d = df if where is None else df.filter(where)
    return d.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")

"""Picking rows: first of a kind, winners of groups, first match of ordered terms.

Every choice has an explicit order, since ``dropDuplicates`` keeps any row. Groups that a row_number would send to one task are
cut down first by aggregation with a struct maximum, which combines on the map side and so stands a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tamis.session import checkpoint


def _flat(best: DataFrame, keys: list[str], struct: str, columns: list[str]) -> DataFrame:
    return best.select(*[F.col(struct)["row"][c].alias(c) for c in columns])


def winner(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row of each group that comes last in ``order`` (ascending columns; negate or invert for others).

    Nulls come first, so a row with a value beats one without. Ties are broken by all the row's columns that can be ordered.
    Rows with null keys are a group like any other.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    ranked = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], row.alias("row"))
    return _flat(df.groupBy(*keys).agg(F.max(ranked).alias("w")), keys, "w", df.columns)


def first_wins(df: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """The row of each group with the smallest ``sequence``; a null sequence counts as the largest."""
    row = F.struct(*[F.col(c) for c in df.columns])
    ranked = F.struct(F.col(sequence).isNull().alias("n"), F.col(sequence).alias("s"), row.alias("row"))
    return _flat(df.groupBy(*keys).agg(F.min(ranked).alias("w")), keys, "w", df.columns)


def latest(df: DataFrame, keys: list[str], time: str, *ties: str) -> DataFrame:
    """The row of each group with the greatest time, then the greatest ties."""
    return winner(df, keys, [F.col(time), *[F.col(t) for t in ties]])


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group; Spark limits each partition's groups before the shuffle."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_rn") <= n).drop("_rn")


def first_term(text: Column, terms: list[str]) -> Column:
    """The first of an ordered list of terms that a text contains, in lower case on both sides; null if none.

    The list is a parameter of the query; for term tables see ``first_term_join``.
    """
    t = F.lower(text)
    out = F.lit(None).cast("string")
    for term in reversed(terms):
        out = F.when(t.contains(term.lower()), term).otherwise(out)
    return out


def first_term_of_table(df: DataFrame, text: str, terms: DataFrame, term: str = "term", order: str = "ord", limit: int = 5_000) -> DataFrame:
    """The same with a table of terms: column ``matched`` added.

    The table is a list that people write; it is read on the driver and becomes part of the expression. More than ``limit``
    terms are refused.
    """
    rows = terms.filter(F.col(term).isNotNull()).select(order, term).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} terms")
    listed = [r[1] for r in sorted(rows, key=lambda r: (r[0] is None, r[0], r[1]))]
    if not listed:
        return df.withColumn("matched", F.lit(None).cast("string"))
    array = F.array(*[F.lit(x) for x in listed])
    return df.withColumn("matched", F.get(F.filter(array, lambda x: F.contains(F.lower(F.col(text)), F.lower(x))), 0))


def mode_value(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, value, n: the most frequent value of each group, then the shortest, then the first in binary order."""
    n = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    best = n.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("m"), F.length(value).alias("l"), F.col(value).alias("v"))).alias("b"))
    return best.select(*keys, F.col("b.v").alias(value), (-F.col("b.m")).alias("n"))


def first_non_null(df: DataFrame, keys: list[str], sequence: str, columns: list[str]) -> DataFrame:
    """keys and, for each column, the value of the first row of the group that has one."""
    return df.groupBy(*keys).agg(*[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(sequence))).alias(c) for c in columns])


def numbered_slugs(df: DataFrame, base: str, order: str, used: DataFrame | None = None, length: int = 80) -> DataFrame:
    """Column ``allocated``: unique slugs, -2, -3 ... behind those whose base is taken, the base cut so that they fit.

    The base of the first row by ``order`` stays, unless ``used`` (column slug) has it. Numbers start behind the used ones of
    the same base. Rounds follow until no two rows clash, as a cut or a number may give a base that another row has.
    """
    taken = df.sparkSession.createDataFrame([], "slug string") if used is None else used.select(F.lower("slug").alias("slug")).distinct()
    stem = F.regexp_replace("slug", "-[0-9]+$", "")
    last = taken.groupBy(stem.alias("_b")).agg(F.max(F.coalesce(F.regexp_extract("slug", "-([0-9]+)$", 1).try_cast("int"), F.lit(1))).alias("_last"))
    d = df.withColumn("_b", F.lower(base)).join(last, "_b", "left")
    d = d.withColumn("_n", F.row_number().over(Window.partitionBy("_b").orderBy(order)) + F.coalesce("_last", F.lit(0))).withColumn("_row", F.monotonically_increasing_id())
    # cut bases that begin alike may get the same slugs, so they are numbered on together
    family = F.left("_b", F.greatest(F.lit(1), F.lit(length - 12)))
    tail = F.concat(F.lit("-"), F.col("_n").cast("string"))
    own = Window.partitionBy("_slug").orderBy((F.col("_n") > 1).cast("int"), order, "_row")
    done, going = None, checkpoint(d.drop("_last"))
    while True:
        named = going.withColumn("allocated", F.when(F.col("_n") == 1, F.col(base)).otherwise(F.concat(F.left(F.col(base), F.lit(length) - F.length(tail)), tail)))
        named = named.withColumn("_slug", F.lower("allocated")).withColumn("_at", F.row_number().over(own)).join(taken.select(F.col("slug").alias("_slug"), F.lit(True).alias("_had")), "_slug", "left")
        named = checkpoint(named.withColumn("_clash", F.col("_slug").isNotNull() & ((F.col("_at") > 1) | F.col("_had").isNotNull())))
        settled = named.filter(~F.col("_clash")).drop("_at", "_had", "_clash")
        done = settled if done is None else done.unionByName(settled)
        clash = named.filter("_clash")
        if clash.isEmpty():
            return done.select(*df.columns, "allocated")
        taken = taken.unionByName(settled.filter("_slug is not null").select(F.col("_slug").alias("slug")))
        top = done.select("_b", "_n").unionByName(clash.select("_b", "_n")).groupBy(family.alias("_f")).agg(F.max("_n").alias("_top"))
        again = clash.select(*df.columns, "_b", "_row", family.alias("_f")).join(top, "_f")
        going = checkpoint(again.withColumn("_n", F.col("_top") + F.row_number().over(Window.partitionBy("_f").orderBy(order, "_row"))).drop("_f", "_top"))


def next_positions(existing: DataFrame, new: DataFrame, keys: list[str], position: str, order: str) -> DataFrame:
    """``new`` with positions that go on after the greatest one of each group in ``existing``, from 0 in a group without."""
    last = existing.groupBy(*keys).agg(F.max(position).alias("_last"))
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return new.withColumn("_n", n).join(last, keys, "left").withColumn(position, F.coalesce("_last", F.lit(-1)) + F.col("_n")).drop("_n", "_last")


def rank_order(value: Column, order: list) -> Column:
    """Place of a value in a fixed order; values outside it, null included, come last. For ORDER BY."""
    at = F.array_position(F.array(*[F.lit(x) for x in order]), value)
    return F.when(F.coalesce(at, F.lit(0)) == 0, len(order) + 1).otherwise(at)


def backoff_schedule(df: DataFrame, attempt: str, base_ms: int, factor: float = 2.0, limit_ms: int | None = None) -> DataFrame:
    """Columns wait_ms of an attempt (from 1) and due_ms, the sum of all waits up to it."""
    n = F.col(attempt)
    wait = F.lit(float(base_ms)) * F.pow(F.lit(factor), n - 1)
    if limit_ms is None:
        due = F.lit(float(base_ms)) * (F.pow(F.lit(factor), n) - 1) / (factor - 1) if factor != 1 else F.lit(float(base_ms)) * n
        return df.withColumns({"wait_ms": wait.cast("bigint"), "due_ms": due.cast("bigint")})
    each = F.transform(F.sequence(F.lit(1), n), lambda i: F.least(F.lit(float(limit_ms)), F.lit(float(base_ms)) * F.pow(F.lit(factor), i - 1)))
    return df.withColumns({"wait_ms": F.least(F.lit(float(limit_ms)), wait).cast("bigint"), "due_ms": F.aggregate(each, F.lit(0.0), lambda a, x: a + x).cast("bigint")})

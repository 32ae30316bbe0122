"""Joins with conditions on how many partners there are, on place and on priority. Plain joins are left to Catalyst."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def unknown_only(df: DataFrame, known: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose key isn't known, rows whose key is). A null key is never known."""
    k = known.select(*keys).distinct()
    return df.join(k, keys, "left_anti"), df.join(k, keys, "left_semi")


def without_recent(df: DataFrame, events: DataFrame, key: str, time: str, since: Column) -> DataFrame:
    """Rows whose key has no event from ``since`` on; keys without events stay. Events without a time count as recent."""
    recent = events.filter((F.col(time) >= since) | F.col(time).isNull()).select(key).distinct()
    return df.join(recent, key, "left_anti")


def unique_partner(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left rows with the columns of their only right partner; where there are none or several, those are null.

    ``partners`` tells how many there are. The right side is brought to one row per key before the join.
    """
    rest = [c for c in right.columns if c not in keys]
    one = right.groupBy(*keys).agg(F.count("*").alias("partners"), *[F.first(c).alias(c) for c in rest])
    only = one.select(*keys, "partners", *[F.when(F.col("partners") == 1, F.col(c)).alias(c) for c in rest])
    return left.join(only, keys, "left").withColumn("partners", F.coalesce("partners", F.lit(0)))


def null_safe_partner(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], key: str) -> DataFrame:
    """Left rows with ``partner`` (the least right key), ``candidates`` and ``ambiguous``; nulls equal nulls."""
    r = right.select(F.col(key).alias("_k"), *[F.col(b).alias(f"_r{i}") for i, (_, b) in enumerate(pairs)])
    r = r.groupBy(*[f"_r{i}" for i in range(len(pairs))]).agg(F.count("*").alias("candidates"), F.min("_k").alias("partner"))
    cond = [F.col(a).eqNullSafe(F.col(f"_r{i}")) for i, (a, _) in enumerate(pairs)]
    out = left.join(r, cond, "left").drop(*[f"_r{i}" for i in range(len(pairs))])
    return out.withColumn("candidates", F.coalesce("candidates", F.lit(0))).withColumn("ambiguous", F.col("candidates") > 1)


def match_kind(records: DataFrame, entities: DataFrame, key: str, id_col: str) -> DataFrame:
    """Records with ``kind`` (match, ambiguous, create) and ``matched`` (the entity's id) by an equal key; null keys create."""
    e = entities.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"), F.min(id_col).alias("matched"))
    kind = F.when(F.col("_n").isNull(), "create").when(F.col("_n") == 1, "match").otherwise("ambiguous")
    return records.join(e, key, "left").withColumn("kind", kind).withColumn("matched", F.when(F.col("_n") == 1, F.col("matched"))).drop("_n")


def cascade(records: DataFrame, id_col: str, rules: list[tuple[str, DataFrame]]) -> DataFrame:
    """id, rule, kind, matched: the first rule by which a record has candidates decides.

    rules: (name, candidates with id_col and candidate) in order of priority; one candidate is a match, several a conflict.
    Records without candidates under any rule have kind create. Each rule looks only at the records that are still open.
    """
    open_, out = records.select(id_col).distinct(), None
    for name, pairs in rules:
        hit = pairs.select(id_col, "candidate").distinct().join(open_, id_col, "left_semi").groupBy(id_col).agg(F.count("*").alias("_n"), F.min("candidate").alias("_c"))
        hit = hit.select(id_col, F.lit(name).alias("rule"), F.when(F.col("_n") == 1, "match").otherwise("conflict").alias("kind"), F.when(F.col("_n") == 1, F.col("_c")).alias("matched"))
        out = hit if out is None else out.unionByName(hit)
        open_ = open_.join(hit.select(id_col), id_col, "left_anti")
    rest = open_.select(id_col, F.lit("none").alias("rule"), F.lit("create").alias("kind"), F.lit(None).cast("string").alias("matched"))
    return rest if out is None else out.unionByName(rest)


def grid_cell(value: Column, size: float) -> Column:
    return F.floor(value / size).cast("bigint")


def near_pairs(a: DataFrame, b: DataFrame, a_id: str, b_id: str, x: str, y: str, size: float) -> DataFrame:
    """a_id, b_id of points less than ``size`` apart in both coordinates: an equi join on grid cells, one side in 3 x 3 cells.

    Points with a null coordinate have no partner. The smaller side should be ``b``, which is spread out.
    """
    left = a.select(F.col(a_id).alias("ia"), F.col(x).alias("xa"), F.col(y).alias("ya")).withColumns({"cx": grid_cell(F.col("xa"), size), "cy": grid_cell(F.col("ya"), size)})
    right = b.select(F.col(b_id).alias("ib"), F.col(x).alias("xb"), F.col(y).alias("yb")).filter("xb is not null and yb is not null")
    around = F.array(F.lit(-1), F.lit(0), F.lit(1))
    right = right.withColumn("dx", F.explode(around)).withColumn("dy", F.explode(around))
    right = right.withColumns({"cx": grid_cell(F.col("xb"), size) + F.col("dx"), "cy": grid_cell(F.col("yb"), size) + F.col("dy")}).drop("dx", "dy")
    close = (F.abs(F.col("xa") - F.col("xb")) < size) & (F.abs(F.col("ya") - F.col("yb")) < size)
    return left.join(right, ["cx", "cy"]).filter(close).select(F.col("ia").alias(a_id + "_a"), F.col("ib").alias(b_id + "_b"))


def child_hosts(hosts: DataFrame, host: str = "host") -> DataFrame:
    """child, parent of hosts of which one is the other with a further label in front; an equi join on the host's tail."""
    h = hosts.select(F.col(host).alias("h")).filter("h is not null").distinct()
    tail = h.select(F.col("h").alias("child"), F.regexp_extract("h", r"^[^.]+\.(.+)$", 1).alias("parent")).filter("parent != ''")
    return tail.join(h.select(F.col("h").alias("parent")), "parent").select("child", "parent")


def conflicts(incoming: DataFrame, existing: DataFrame, id_col: str, host: str, name_key: str, other_id: str | None = None) -> DataFrame:
    """id, reason, other: why a record can't be created: same_host, same_name or related_host, the first that applies.

    The three are equi joins; null hosts and names conflict with nothing.
    """
    i = incoming.select(F.col(id_col).alias("i"), F.col(host).alias("h"), F.col(name_key).alias("n"))
    e = existing.select(F.col(other_id or id_col).alias("other"), F.col(host).alias("eh"), F.col(name_key).alias("en"))
    tail = lambda c: F.nullif(F.regexp_extract(c, r"^[^.]+\.(.+)$", 1), F.lit(""))
    found = [
        i.join(e, F.col("h") == F.col("eh")).select("i", F.lit(1).alias("p"), F.lit("same_host").alias("reason"), "other"),
        i.join(e, F.col("n") == F.col("en")).select("i", F.lit(2).alias("p"), F.lit("same_name").alias("reason"), "other"),
        i.join(e, F.col("h") == tail(F.col("eh"))).select("i", F.lit(3).alias("p"), F.lit("related_host").alias("reason"), "other"),
        i.join(e, tail(F.col("h")) == F.col("eh")).select("i", F.lit(3).alias("p"), F.lit("related_host").alias("reason"), "other"),
    ]
    every = found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])
    return every.groupBy("i").agg(F.min(F.struct("p", "other", "reason")).alias("m")).select(F.col("i").alias(id_col), F.col("m.reason").alias("reason"), F.col("m.other").alias("other"))


def stored_matches(observed: DataFrame, stored: DataFrame, keys: list[str], observed_at: str, checked_at: str) -> DataFrame:
    """Stored rows with an observation of their key that isn't older than their last check (a null check is oldest)."""
    o = observed.groupBy(*keys).agg(F.max(observed_at).alias("_at"))
    return stored.join(o, keys).filter(F.coalesce(F.col(checked_at) <= F.col("_at"), F.lit(True))).drop("_at")


def difference(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """keys, side (gone or new) of the keys that only one of two inventories has."""
    b, a = before.select(*keys).distinct().withColumn("_b", F.lit(True)), after.select(*keys).distinct().withColumn("_a", F.lit(True))
    full = b.join(a, keys, "full")
    return full.filter("_a is null or _b is null").select(*keys, F.when(F.col("_a").isNull(), "gone").otherwise("new").alias("side"))


def same_multiset(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row (missing, extra): rows of a that b lacks and of b that a lacks, with repetitions; 0, 0 if the tables are equal."""
    n = a.withColumn("_d", F.lit(1)).unionByName(b.withColumn("_d", F.lit(-1))).groupBy(*a.columns).agg(F.sum("_d").alias("d"))
    return n.agg(F.coalesce(F.sum(F.greatest("d", F.lit(0))), F.lit(0)).alias("missing"), F.coalesce(F.sum(F.greatest(-F.col("d"), F.lit(0))), F.lit(0)).alias("extra"))


def in_same_place(a: Column, b: Column, region_a: Column, region_b: Column, within: Column | None = None) -> Column:
    """Whether two towns are the same as far as is known: equal, regions not in conflict, or one named in a longer text."""
    town = (a == b) & (region_a.isNull() | region_b.isNull() | (region_a == region_b))
    return F.coalesce(town, F.lit(False)) | (F.coalesce(F.contains(within, b), F.lit(False)) if within is not None else F.lit(False))


def count_over(df: DataFrame, keys: list[str], name: str = "group_size") -> DataFrame:
    """``df`` with the number of rows of its group: a pre-aggregated count joined back, which stands a hot group."""
    return df.join(df.groupBy(*keys).agg(F.count("*").alias(name)), keys, "left")


def order_violations(df: DataFrame, keys: list[str], order: str, time: str) -> DataFrame:
    """keys, order, time, previous of the rows whose time is before that of the row ahead of them in the group."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("previous", F.lag(time).over(w)).filter(F.col(time) < F.col("previous")).select(*keys, order, time, "previous")

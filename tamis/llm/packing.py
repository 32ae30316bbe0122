"""Filling containers of fixed capacity with items, from the histogram of their sizes.

The driver sees only the histogram, at most one row per size up to the capacity. A dynamic program over it chooses length
buckets of least padding. Batches form inside each bucket, longest bucket first: items of the bucket are taken while the token
budget lasts, the last ones so that least room stays. Only room that no item left in the bucket fits is topped up from shorter
buckets, since batches of a single bucket would waste it; the summary counts the pieces that this moves. The outcome is a short list of patterns (how many containers hold which sizes), to which the rows are matched in Spark.
"""

from __future__ import annotations

import bisect

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tamis.session import checkpoint

#: Least number of parts into which the items of one size are divided for numbering, so that no size makes one large task; there
#: are as many as shuffle partitions where those are more.
SALTS = 64


def length_buckets(sizes: list[int], counts: list[int], k: int) -> list[int]:
    """Upper bounds of at most ``k`` buckets over ascending sizes with the least sum of (bound - size) * count. Exact."""
    s, c = np.asarray(sizes, np.float64), np.asarray(counts, np.float64)
    n = len(s)
    if not n:
        return []
    cum, mass = np.r_[0, np.cumsum(c)], np.r_[0, np.cumsum(c * s)]
    best = s * cum[1:] - mass[1:]  # one bucket over 0..j
    choice = []
    for _ in range(min(k, n) - 1):
        new, arg = best.copy(), np.full(n, -1)
        for j in range(1, n):
            # the last bucket holds i+1..j
            cost = best[:j] + s[j] * (cum[j + 1] - cum[1 : j + 1]) - (mass[j + 1] - mass[1 : j + 1])
            i = int(np.argmin(cost))
            if cost[i] < new[j]:
                new[j], arg[j] = cost[i], i
        choice.append(arg)
        best = new
    bounds, j = [], n - 1
    for arg in reversed(choice):
        bounds.append(sizes[j])
        if arg[j] < 0:
            continue
        j = int(arg[j])
    bounds.append(sizes[j])
    return sorted(set(bounds))


def _fill(live: np.ndarray, left: dict[int, int], room: int) -> tuple[list[tuple[int, int]], int]:
    """Items of the ascending sizes ``live`` for ``room``: (chosen sizes with numbers, room that stays).

    Longest first while more than two of the longest fit; then the pair, or the one, that leaves least.
    """
    taken: dict[int, int] = {}
    while len(live) and room >= live[0]:
        live = live[: np.searchsorted(live, room, "right")]
        top = int(live[-1])
        n = min(room // top - 2, left[top] - taken.get(top, 0))
        if n > 0:
            chosen = [(top, n)]
        else:
            spare = np.array([left[int(x)] - taken.get(int(x), 0) for x in live]) if taken else np.array([left[int(x)] for x in live])
            live, spare = live[spare > 0], spare[spare > 0]
            if not len(live):
                break
            at = np.searchsorted(live, room - live, "right") - 1
            at = np.where((at >= 0) & (live[at] == live) & (spare < 2), at - 1, at)
            both = np.where(at >= 0, live + live[at], 0)
            i = int(both.argmax())
            chosen = [(int(live[i]), 1), (int(live[at[i]]), 1)] if both[i] > live[-1] else [(int(live[-1]), 1)]
        for s, k in chosen:
            taken[s] = taken.get(s, 0) + k
            room -= s * k
        if n > 0 and taken[top] == left[top]:
            live = live[:-1]
    return list(taken.items()), room


def pack_histogram(sizes: list[int], counts: list[int], capacity: int, bounds: list[int]) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Patterns [(containers, bound of their bucket, [(size, items per container)])].

    Buckets go from the longest to the shortest. A batch takes items of its own bucket, the closing ones chosen for the least room
    that stays; only room that no item left in the bucket fits is topped up from shorter ones. Each pattern is repeated while
    all its sizes last, so there are about as many patterns as sizes, however many items.
    """
    left = dict(zip(sizes, counts))
    live = np.array(sorted(x for x in sizes if left[x] > 0), np.int64)
    out = []
    for lower, bound in reversed(list(zip([0, *bounds], bounds))):
        while len(live) and live[-1] > lower:
            cut = int(np.searchsorted(live, lower, "right"))
            pattern, room = _fill(live[cut:], left, capacity)
            more, _ = _fill(live[:cut], left, room)
            pattern += more
            times = min(left[s] // n for s, n in pattern)
            for s, n in pattern:
                left[s] -= n * times
                if not left[s]:
                    live = np.delete(live, np.searchsorted(live, s))
            out.append((times, bound, pattern))
    return out


def pack_items(items: DataFrame, specs: list[tuple], *, key: str = "doc_id", kind: str = "kind", size: str = "n_tokens", buckets: int = 16) -> tuple[DataFrame, DataFrame]:
    """(assignment, summary) of items to containers.

    specs: (spec_id, capacity, kind or None for all). Assignment: spec_id, container_id, bucket_tokens, key, piece_no, n_tokens;
    one row per piece, bucket_tokens being the bound of the container's longest bucket. Only an item above the capacity is
    split: into full pieces and one rest. Items of size null or 0 or less aren't packed; nor are items of null kind where a spec
    names one. Specs without a positive capacity hold nothing. Repeated rows are items of their own. The items should be cheap
    to read twice. Summary: a row for each spec; topped_up are the pieces that stand in a container of a longer bucket.
    """
    spark = items.sparkSession
    specs = [s for s in specs if s[0] is not None and s[1] is not None and s[1] > 0]
    base = items.select(F.col(key).alias("k"), F.col(kind).alias("kind"), F.col(size).cast("bigint").alias("n")).filter("n > 0")
    wanted = F.array(*[F.when(F.lit(s[2] is None) | (F.col("kind") == s[2]), F.struct(F.lit(int(s[0])).alias("spec_id"), F.lit(int(s[1])).cast("bigint").alias("capacity"))) for s in specs]) if specs else F.expr("array(cast(null as struct<spec_id:int,capacity:bigint>))")
    pieces = base.withColumn("spec", F.explode(F.filter(wanted, lambda x: x.isNotNull()))).select("spec.*", "k", "n")
    pieces = pieces.withColumn("piece_no", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / F.col("capacity")).cast("int") - 1)))
    pieces = pieces.select("spec_id", "k", "piece_no", F.least("capacity", F.col("n") - F.col("piece_no") * F.col("capacity")).alias("size"))
    salts = max(SALTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pieces = pieces.withColumn("salt", F.pmod(F.xxhash64("k", "piece_no"), F.lit(salts)).cast("int"))

    by_salt = pieces.groupBy("spec_id", "size", "salt").agg(F.count("*").alias("n"))
    histogram: dict[int, list[tuple[int, int]]] = {}
    for r in by_salt.groupBy("spec_id", "size").agg(F.sum("n").alias("n")).orderBy("spec_id", "size").toLocalIterator():
        histogram.setdefault(r[0], []).append((r[1], r[2]))
    slots, summary = [], []
    for spec_id, capacity, of in specs:
        h = histogram.get(spec_id, [])
        sizes, counts = [x[0] for x in h], [x[1] for x in h]
        bounds = length_buckets(sizes, counts, buckets)
        next_container, next_item = 0, dict.fromkeys(sizes, 0)
        moved = 0
        for times, bound, pattern in pack_histogram(sizes, counts, capacity, bounds):
            for s, n in pattern:
                moved += n * times if bounds[bisect.bisect_left(bounds, s)] < bound else 0
                slots.append((spec_id, s, next_item[s], next_item[s] + n * times, next_container, n, bound))
                next_item[s] += n * times
            next_container += times
        total = sum(s * n for s, n in h)
        padding = sum((bounds[bisect.bisect_left(bounds, s)] - s) * n for s, n in h)
        summary.append((spec_id, capacity, of, sum(counts), total, next_container, -(-total // capacity), bounds, padding, moved))
    slot = spark.createDataFrame(slots, "spec_id int, size bigint, item_from bigint, item_to bigint, container_from bigint, per_container bigint, bucket_tokens bigint")
    before = Window.partitionBy("spec_id", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_salt.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    own = Window.partitionBy("spec_id", "size", "salt").orderBy("k", "piece_no")
    numbered = pieces.withColumn("rn", F.row_number().over(own)).join(offsets, ["spec_id", "size", "salt"]).withColumn("item", F.col("before") + F.col("rn") - 1)
    placed = numbered.join(slot, (numbered.spec_id == slot.spec_id) & (numbered["size"] == slot["size"]) & (F.col("item") >= F.col("item_from")) & (F.col("item") < F.col("item_to")))
    assignment = placed.select(
        numbered.spec_id, (F.col("container_from") + F.floor((F.col("item") - F.col("item_from")) / F.col("per_container"))).cast("bigint").alias("container_id"),
        "bucket_tokens", F.col("k").alias(key), "piece_no", numbered["size"].alias("n_tokens"),
    )
    report = spark.createDataFrame(summary, "spec_id int, capacity_tokens bigint, doc_kind string, pieces bigint, tokens bigint, containers bigint, least_possible bigint, bucket_bounds array<bigint>, padding_tokens bigint, topped_up bigint")
    return assignment, report


def sized_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, kind, n_tokens of the non-empty documents; written once, for it is read again."""
    from tamis.llm.bpe import token_counts

    return checkpoint(docs.select("doc_id", "kind", token_counts(F.col("text"), path).alias("n_tokens")).filter("n_tokens > 0"))


def read_specs(specs: DataFrame) -> list[tuple]:
    """The specs as tuples; a parameter table of a few rows (at most 1,000)."""
    rows = specs.select("spec_id", "capacity_tokens", "doc_kind").orderBy("spec_id").limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("more than 1,000 container specs")
    return [tuple(r) for r in rows]

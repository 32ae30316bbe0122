"""Containers: exact buckets against brute force, no overflow, nothing lost, few containers, hot sizes."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tamis.llm import packing


def padding(sizes, counts, bounds):
    return sum((min(b for b in bounds if b >= s) - s) * c for s, c in zip(sizes, counts))


@pytest.mark.parametrize("seed", range(12))
def test_buckets_are_optimal(seed):
    r = random.Random(seed)
    sizes = sorted(r.sample(range(1, 60), r.randint(1, 9)))
    counts = [r.randint(1, 9) for _ in sizes]
    for k in (1, 2, 3, 5):
        best = min(padding(sizes, counts, [*c, sizes[-1]]) for n in range(min(k, len(sizes))) for c in itertools.combinations(sizes[:-1], n))
        got = packing.length_buckets(sizes, counts, k)
        assert len(got) <= k and padding(sizes, counts, got) == best


def test_no_sizes():
    assert packing.length_buckets([], [], 4) == [] and packing.pack_histogram([], [], 10, []) == []


@pytest.mark.parametrize("seed", range(8))
def test_patterns_use_all_items_and_fit(seed):
    r = random.Random(seed)
    cap = r.choice([16, 100, 512])
    h = {r.randint(1, cap): r.randint(1, 400) for _ in range(40)}
    sizes = sorted(h)
    used = dict.fromkeys(sizes, 0)
    bounds = packing.length_buckets(sizes, [h[s] for s in sizes], r.randint(1, 6))
    out = packing.pack_histogram(sizes, [h[s] for s in sizes], cap, bounds)
    for times, bound, pattern in out:
        assert sum(s * n for s, n in pattern) <= cap and bound in bounds and max(s for s, _ in pattern) <= bound
        for s, n in pattern:
            used[s] += n * times
    assert used == h
    least = -(-sum(s * n for s, n in h.items()) // cap)
    big = sum(n for s, n in h.items() if 2 * s > cap)
    assert sum(t for t, _, _ in out) <= max(least, big) * 1.25 + 2


def test_batches_keep_to_their_bucket_while_it_has_items():
    sizes, counts = [10, 30, 40, 45, 55, 60], [4, 4, 2, 2, 2, 2]
    for bounds in ([60], [30, 60], [45, 60], [10, 30, 40, 60]):
        left = dict(zip(sizes, counts))
        for times, bound, pattern in packing.pack_histogram(sizes, counts, 100, bounds):
            lower = max([b for b in bounds if b < bound], default=0)
            room = 100 - sum(s * n for s, n in pattern if s > lower)
            for s, n in pattern:
                left[s] -= n * times
            # topped up only where no item left in the bucket would have fitted
            if any(s <= lower for s, _ in pattern):
                assert not any(left[s] and lower < s <= bound and s <= room for s in sizes)


def test_buckets_decide_the_batches():
    r = random.Random(3)
    h = {}
    for _ in range(5000):
        x = min(512, max(1, int(r.lognormvariate(4.5, 0.7))))
        h[x] = h.get(x, 0) + 1
    sizes = sorted(h)
    counts = [h[s] for s in sizes]
    least = -(-sum(s * n for s, n in h.items()) // 512)
    made = []
    for k in (1, 4, 16):
        out = packing.pack_histogram(sizes, counts, 512, packing.length_buckets(sizes, counts, k))
        assert sum(t for t, _, _ in out) <= least * 1.01 + 1
        made.append(sorted((t, tuple(sorted(p))) for t, _, p in out))
    assert made[0] != made[1] != made[2]


SCHEMA = "doc_id bigint, kind string, n_tokens bigint, size string, salt int"


def test_assignment(spark):
    r = random.Random(1)
    rows = [(i, r.choice(["review", "news", None]), 7 if i % 3 == 0 else r.randint(1, 90), "x", 1) for i in range(3000)]
    rows += [(9001, "review", 250, "x", 1), (9002, "review", 0, "x", 1), (9003, "review", None, "x", 1), (9004, "news", 200, "x", 1), (5, "review", 7, "x", 1), (5, "review", 7, "x", 1)]
    items = spark.createDataFrame(rows, SCHEMA)
    specs = [(1, 100, "review"), (2, 128, None), (3, None, None), (4, 50, "unheard of")]
    placed, report = packing.pack_items(items, specs)
    placed = placed.cache()
    kept = [x for x in rows if x[2]]
    for spec, cap, kind in specs[:2]:
        own = placed.filter(F.col("spec_id") == spec)
        mine = [x for x in kept if kind in (None, x[1])]
        load = own.groupBy("container_id").agg(F.sum("n_tokens").alias("t"))
        assert load.agg(F.max("t")).first()[0] <= cap
        assert own.agg(F.sum("n_tokens")).first()[0] == sum(x[2] for x in mine)
        assert own.count() == sum(-(-x[2] // cap) for x in mine)
        row = report.filter(F.col("spec_id") == spec).first()
        assert load.count() == row["containers"] <= row["least_possible"] * 1.03 + 1
    assert placed.filter("spec_id = 1 and doc_id = 9001").agg(F.count("*"), F.sum("n_tokens")).first()[:] == (3, 250)
    assert placed.filter("spec_id = 2 and doc_id = 9004").count() == 2
    assert {x[0] for x in placed.select("spec_id").distinct().collect()} == {1, 2}
    # only items above the capacity are split
    split = placed.groupBy("spec_id", "doc_id").count().filter("count > 1 and doc_id <> 5").collect()
    assert {(x[0], x[1]) for x in split} == {(1, 9001), (2, 9001), (1, 9004), (2, 9004)} - {(1, 9004)}


def test_empty(spark):
    placed, report = packing.pack_items(spark.createDataFrame([], SCHEMA), [(1, 10, None)])
    assert placed.count() == 0 and report.first()["containers"] == 0
    placed, report = packing.pack_items(spark.createDataFrame([], SCHEMA), [])
    assert placed.count() == 0 and report.count() == 0

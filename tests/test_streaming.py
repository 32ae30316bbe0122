"""Streams give what the batch operators give on the same rows."""

import datetime
import random
import shutil

import pytest
from pyspark.sql import functions as F

from tamis.operators.merge import accepted_in_order, merge
from tamis.sources.files import read_version, versions
from tamis.streaming import observations as O

SCHEMA_COLUMNS = ("k", "n", "at", "state", "price")
SCHEMA = "k string, n bigint, at timestamp, state string, price int"


def at(minute):
    return None if minute is None else datetime.datetime(2026, 1, 1, 0, minute)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture()
def feed(spark, tmp_path):
    r = random.Random(5)
    data = [(r.choice("abc"), i, at(r.choice([*range(20), None])), r.choice(["in", "out", None]), r.randint(1, 3)) for i in range(60)]
    for i in range(3):
        spark.createDataFrame(data[i * 20 : i * 20 + 20], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    return stream, spark.createDataFrame(data, SCHEMA), tmp_path


def run(df, tmp_path, name):
    q = df.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / f"{name}-cp")).option("path", str(tmp_path / name)).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.read.parquet(str(tmp_path / name))


def test_guard_equals_batch(feed):
    stream, batch, tmp = feed
    got = run(O.guarded(stream, ["k"], "n", "at", ["state", "price"]), tmp, "guard")
    want = accepted_in_order(batch, ["k"], "n", "at")
    assert rows(got, "k", "n", "stale") == rows(want, "k", "n", "stale")
    ordered = sorted(want.collect(), key=lambda r: r["n"])
    held, changed = {}, set()
    for r in ordered:
        now = (r["state"], r["price"])
        if not r["stale"]:
            if held.get(r["k"]) != now:
                changed.add(r["n"])
            held[r["k"]] = now
    assert {r[0] for r in rows(got.filter("changed"), "n")} == changed


def test_first_of_key(feed):
    stream, batch, tmp = feed
    got = run(O.first_of_key(stream, ["k"], "n"), tmp, "first")
    assert rows(got, "k", "n") == rows(batch.groupBy("k").agg(F.min("n").alias("n")), "k", "n")


def test_merge_stream(spark, feed):
    stream, batch, tmp = feed
    own = [str(tmp / x) for x in ("table", "outbox", "cp")]
    q = O.merge_stream(stream.filter("at is not null"), *own, ["k"], "at", ["state", "price"])
    q.awaitTermination(120)
    assert q.exception() is None
    table = read_version(spark, own[0])
    assert rows(table, "k", "at") == rows(batch.groupBy("k").agg(F.max("at").alias("at")), "k", "at")
    n = spark.read.parquet(own[1]).count()
    # rows seen again change nothing and make no event
    O.merge_batch(table.select(*SCHEMA_COLUMNS), own[0], own[1], ["k"], "at", ["state", "price"])
    again = read_version(spark, own[0])
    assert rows(again, *SCHEMA_COLUMNS) == rows(table, *SCHEMA_COLUMNS) and spark.read.parquet(own[1]).count() == n
    assert merge(again, again, ["k"], "at", ["state", "price"])[1].count() == 0


def test_failed_batch_repeats_no_event(spark, tmp_path):
    table, outbox = str(tmp_path / "t"), str(tmp_path / "o")
    batch = lambda *rows: spark.createDataFrame(rows, "k string, at timestamp, state string")
    day = lambda n: datetime.datetime(2026, 1, n)
    O.merge_batch(batch(("a", day(1), "in")), table, outbox, ["k"], "at", ["state"], batch_id=0)
    second = batch(("a", day(2), "out"), ("b", day(2), "in"))
    O.merge_batch(second, table, outbox, ["k"], "at", ["state"], batch_id=1)
    # the events of the second batch stand, its version was lost: it comes again, then once more after it was done
    shutil.rmtree(f"{table}/v={versions(spark, table)[-1]}")
    for _ in range(2):
        O.merge_batch(second, table, outbox, ["k"], "at", ["state"], batch_id=1)
    events = sorted((r["k"], r["change"], r["batch"]) for r in spark.read.parquet(outbox).collect())
    assert events == [("a", "insert", 0), ("a", "update", 1), ("b", "insert", 1)]
    assert sorted((r["k"], r["state"]) for r in read_version(spark, table).collect()) == [("a", "out"), ("b", "in")]


def test_cache(spark):
    now = F.lit(datetime.datetime(2026, 1, 8, 0, 0))
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), (None,)], "k string")
    cache = spark.createDataFrame([("a", datetime.datetime(2026, 1, 7), "x"), ("a", datetime.datetime(2026, 1, 6), "old"), ("b", datetime.datetime(2026, 1, 1), "y"), ("c", datetime.datetime(2026, 1, 9), "z")], "k string, stored timestamp, v string")
    assert rows(O.fresh(df, cache, ["k"], "stored", now, 7), "k", "v", "cached") == [("a", "x", True), ("b", None, False), ("c", None, False), ("d", None, False), (None, None, False)]


def test_retries(spark):
    log = spark.createDataFrame([("h", 1, at(1), True), ("h", 2, at(2), True), ("h", 3, at(3), False), ("h", 4, at(4), True), ("g", 1, at(1), False)], "host string, n int, at timestamp, failed boolean")
    got = O.retry_times(log, "host", "n", "at", "failed", 60, 2.0, 100)
    assert rows(got, "host", "n", "streak", "due") == sorted([("g", 1, 0, at(1)), ("h", 1, 1, at(2)), ("h", 2, 2, at(3) + datetime.timedelta(seconds=40)), ("h", 3, 0, at(3)), ("h", 4, 1, at(5))], key=repr)

"""Observation streams: the guard against late data, the merge into a table with its outbox, caches that expire, retries."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.window import Window

from tamis.operators.merge import merge
from tamis.sources.files import read_version, versions, write_version


def guarded(stream: DataFrame, keys: list[str], arrival: str, time: str, compare: list[str]) -> DataFrame:
    """A stream with ``stale`` and ``changed`` per row, by one state per key: its last time and last accepted values.

    A row older than the key's last time is stale, changes nothing and stays in the stream, marked. Equal times are accepted.
    ``changed`` tells whether a row differs in ``compare`` from the accepted one before it; the first one always does. This is no
    watermark: a key's lateness is measured by its own history. Rows of a batch are taken in order of ``arrival``.
    """
    schema = T.StructType([*stream.schema.fields, T.StructField("stale", T.BooleanType()), T.StructField("changed", T.BooleanType())])
    names = stream.columns

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, held = state.get if state.exists else (None, None)
        rows = pd.concat(list(batches)).sort_values(arrival, kind="stable")
        stale, changed = [], []
        for at, *values in zip(rows[time], *(rows[c] for c in compare)):
            micros = None if pd.isna(at) else int(pd.Timestamp(at).value // 1000)
            now = "\x1f".join("\x00" if pd.isna(v) else str(v) for v in values)
            late = last is not None and micros is not None and micros < last
            stale.append(late)
            changed.append(not late and now != held)
            if not late:
                held = now
                last = micros if last is None else last if micros is None else max(last, micros)
        state.update((last, held))
        out = rows[names].copy()
        out["stale"], out["changed"] = stale, changed
        yield out

    return stream.groupBy(*keys).applyInPandasWithState(run, schema, "last long, held string", "append", GroupStateTimeout.NoTimeout)


def first_of_key(stream: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """The first row of each key, by ``sequence`` within a batch; later batches can't take a key that was seen."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches))
        if not state.exists:
            state.update((True,))
            yield rows.sort_values(sequence, kind="stable").head(1)

    return stream.groupBy(*keys).applyInPandasWithState(run, stream.schema, "seen boolean", "append", GroupStateTimeout.NoTimeout)


def merge_batch(batch: DataFrame, table: str, outbox: str, keys: list[str], time: str, compare: list[str], fill: list[str] | None = None, batch_id: int | None = None) -> None:
    """Merge a batch into a versioned table and put what changed into its outbox; a repeated batch changes nothing.

    The events of a batch stand in a folder of their own under the outbox, named after the batch and written before the table's
    version, which names the batch as well. A batch that failed between the two writes the same events into the same folder
    again; one whose version stands is passed over. Without a ``batch_id`` the next number is taken, so that only a stream's own
    ids protect from repetition. Merged rows are written once and read back for the events.
    """
    spark = batch.sparkSession
    done = versions(spark, table)
    stored = read_version(spark, table) if done else None
    last = int(stored.select(F.max("_batch")).first()[0] or 0) if done and "_batch" in stored.columns else -1
    of = last + 1 if batch_id is None else batch_id
    if done and of <= last:
        return
    plain = stored.drop("_batch") if done else spark.createDataFrame([], batch.schema)
    new, events = merge(plain, batch, keys, time, compare, fill)
    events.write.mode("overwrite").parquet(f"{outbox}/batch={of}")
    # an empty table still has to say which batch it is at, so the number stands in every row of a version that has rows
    write_version(new.withColumn("_batch", F.lit(of).cast("bigint")), table)


def merge_stream(stream: DataFrame, table: str, outbox: str, checkpoint: str, keys: list[str], time: str, compare: list[str], fill: list[str] | None = None, once: bool = True):
    """The streaming query that merges every micro-batch; with ``once`` it ends when all that is there is merged."""
    w = stream.writeStream.foreachBatch(lambda df, i: merge_batch(df, table, outbox, keys, time, compare, fill, i)).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()


def fresh(df: DataFrame, cache: DataFrame, keys: list[str], stored_at: str, now: Column, ttl_days: int) -> DataFrame:
    """``df`` with the cache's other columns where it has an entry of the key with 0 <= age < ttl, and ``cached``."""
    rest = [c for c in cache.columns if c not in keys]
    live = cache.filter((F.col(stored_at) <= now) & (F.col(stored_at) > now - F.expr(f"interval {ttl_days} days")))
    best = live.groupBy(*keys).agg(F.max(F.struct(stored_at, *[c for c in rest if c != stored_at])).alias("c"))
    out = df.join(best, keys, "left")
    return out.select(*df.columns, *[F.col("c")[c].alias(c) for c in rest], F.col("c").isNotNull().alias("cached"))


def retry_times(log: DataFrame, key: str, order: str, time: str, failed: str, base_s: int, factor: float, limit_s: int) -> DataFrame:
    """``log`` with ``streak`` (failures in a row up to a try) and ``due`` (when the next one may start)."""
    w = Window.partitionBy(key).orderBy(order)
    runs = log.withColumn("_run", F.sum((~F.col(failed)).cast("int")).over(w))
    streak = F.sum(F.col(failed).cast("int")).over(Window.partitionBy(key, "_run").orderBy(order))
    runs = runs.withColumn("streak", streak)
    wait = F.when(F.col("streak") == 0, 0.0).otherwise(F.least(F.lit(float(limit_s)), base_s * F.pow(F.lit(factor), F.col("streak") - 1)))
    return runs.withColumn("due", F.timestamp_micros(F.unix_micros(time) + (wait * 1_000_000).cast("bigint"))).drop("_run")

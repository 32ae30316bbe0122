"""A plan of what an import would do, sealed by a hash, and the check that it still fits before it is carried out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.functions.keys import multiset_fingerprint, source_key
from tamis.functions.text import clean, name_problem, strict_name_key
from tamis.functions.url import canonical_host
from tamis.operators.joins import conflicts, match_kind
from tamis.operators.select import first_non_null


def normalised(records: DataFrame, source: str, normalise: bool = True) -> DataFrame:
    """Records (seq, record_id, name, website_url, ...) with host, name_key, source_key and problem (why it is rejected)."""
    host = canonical_host(F.col("website_url"))
    problem = F.coalesce(name_problem(F.col("name")), F.when(host.isNull(), F.lit("no_website")))
    return records.withColumns({"name": clean(F.col("name")), "host": host, "name_key": strict_name_key(F.col("name"), normalise), "source_key": source_key(F.lit(source), F.col("record_id")), "problem": problem})


def merged_inputs(records: DataFrame, columns: list[str]) -> DataFrame:
    """One row per host: the first non-null of every column by seq, its sources, and whether their names differ."""
    good = records.filter("problem is null")
    first = first_non_null(good, ["host"], "seq", ["name", "name_key", "website_url", *columns])
    told = good.groupBy("host").agg(F.count("*").alias("sources"), (F.count_distinct(F.lower("name")) > 1).alias("names_differ"), F.min("seq").alias("seq"), F.min_by("record_id", "seq").alias("record_id"))
    return first.join(told, "host")


def plan(records: DataFrame, entities: DataFrame, columns: list[str]) -> DataFrame:
    """record_id, host, action, reason, entity_id, fields: reject, conflict, enrich, unchanged or create for every host.

    records: output of ``normalised``; entities: id, name_key, host and ``columns``. Hosts decide; a record whose name, or a
    neighbouring host, another entity has is a conflict and never guessed. enrich names the columns that are null now.
    """
    reject = records.filter("problem is not null").select("record_id", "host", F.lit("reject").alias("action"), F.col("problem").alias("reason"), F.lit(None).cast("string").alias("entity_id"), F.lit("").alias("fields"))
    one = merged_inputs(records, columns)
    m = match_kind(one, entities.select("host", "id"), "host", "id")
    e = entities.select(F.col("id").alias("matched"), *[F.col(c).alias(f"e_{c}") for c in columns])
    m = m.join(e, "matched", "left")
    clash = conflicts(m.filter("kind = 'create'").select("record_id", "host", "name_key"), entities, "record_id", "host", "name_key", "id")
    inner = m.filter("kind = 'create'")
    twice = inner.groupBy("name_key").agg(F.count("*").alias("twins")).filter("twins > 1 and name_key is not null")
    m = m.join(clash.withColumnsRenamed({"reason": "clash"}).drop("other"), "record_id", "left").join(twice, "name_key", "left")
    fields = F.array_join(F.array_compact(F.array(*[F.when(F.col(f"e_{c}").isNull() & F.col(c).isNotNull(), F.lit(c)) for c in columns])), ",") if columns else F.lit("")
    action = (
        F.when(F.col("names_differ"), "conflict").when(F.col("kind") == "ambiguous", "conflict")
        .when((F.col("kind") == "create") & (F.col("clash").isNotNull() | F.col("twins").isNotNull()), "conflict")
        .when(F.col("kind") == "create", "create").when(fields != "", "enrich").otherwise("unchanged")
    )
    reason = F.when(F.col("names_differ"), "names_differ").when(F.col("kind") == "ambiguous", "several_entities").when(F.col("clash").isNotNull() & (F.col("kind") == "create"), F.col("clash")).when(F.col("twins").isNotNull() & (F.col("kind") == "create"), "same_name_in_input")
    out = m.select("record_id", "host", action.alias("action"), reason.alias("reason"), F.col("matched").alias("entity_id"), F.when(action == "enrich", fields).otherwise("").alias("fields"))
    return reject.unionByName(out)


def seal(actions: DataFrame) -> str:
    """Hash of a plan's rows, whatever their order."""
    return multiset_fingerprint(actions, *sorted(actions.columns)).first()["fingerprint"]


def usable(actions: DataFrame, sealed: str, planned_at: Column, now: Column, hours: int = 24) -> bool:
    """Whether a plan is the one that was sealed and younger than ``hours``."""
    if seal(actions) != sealed:
        return False
    return bool(actions.sparkSession.range(1).select((now >= planned_at) & (now < planned_at + F.expr(f"interval {hours} hours"))).first()[0])


def action_counts(actions: DataFrame) -> DataFrame:
    return actions.groupBy("action").agg(F.count("*").alias("n"))

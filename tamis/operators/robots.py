"""Which paths a site's robots text allows, as a dataflow: rules are parsed, exploded and joined to the paths asked about."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def rules(texts: DataFrame, host: str = "host", text: str = "text") -> DataFrame:
    """host, no, agent, allow, pattern: a rule for each agent of the group it stands in; empty patterns are no rules.

    A group is a run of agent lines and the rules that follow; an agent line after a rule begins a new one.
    """
    lines = texts.select(F.col(host).alias("host"), F.posexplode(F.split(F.col(text), "\r?\n")).alias("no", "line"))
    lines = lines.withColumn("line", F.trim(F.regexp_replace("line", "#.*$", "")))
    lines = lines.select("host", "no", F.lower(F.trim(F.regexp_extract("line", "^([^:]*):", 1))).alias("key"), F.trim(F.regexp_extract("line", "^[^:]*:(.*)$", 1)).alias("value")).filter("key in ('user-agent', 'allow', 'disallow')")
    w = Window.partitionBy("host").orderBy("no")
    opens = (F.col("key") == "user-agent") & (F.coalesce(F.lag("key").over(w), F.lit("allow")) != "user-agent")
    lines = lines.withColumn("group", F.sum(opens.cast("int")).over(w))
    agents = lines.filter("key = 'user-agent' and value != ''").select("host", "group", F.lower("value").alias("agent")).distinct()
    return lines.filter("key != 'user-agent' and value != ''").join(agents, ["host", "group"]).select("host", "no", "agent", (F.col("key") == "allow").alias("allow"), F.col("value").alias("pattern"))


def allowed(paths: DataFrame, texts: DataFrame, agent: str, wildcards: bool = True) -> DataFrame:
    """``paths`` (host, path) with ``allowed``: the longest matching pattern decides, allow wins a tie, no match allows.

    Rules that name a part of ``agent`` replace those for *. Without ``wildcards`` patterns are plain prefixes. Hosts without a
    text allow everything.
    """
    r = rules(texts)
    mine = r.filter((F.col("agent") != "*") & F.contains(F.lit(agent.lower()), F.col("agent")))
    general = r.filter("agent = '*'").join(mine.select("host").distinct(), "host", "left_anti")
    r = mine.unionByName(general).select("host", "allow", "pattern").distinct()
    if wildcards:
        quoted = F.regexp_replace(F.regexp_replace("pattern", r"\$$", ""), r"([.+?^${}()|\[\]\\])", r"\\$1")
        r = r.withColumn("regex", F.concat(F.lit("^"), F.replace(quoted, F.lit("*"), F.lit(".*")), F.when(F.endswith("pattern", F.lit("$")), "$").otherwise("")))
        hit, length = F.expr("path rlike regex"), F.length(F.regexp_replace("pattern", r"\*|\$$", ""))
    else:
        r = r.withColumn("regex", F.lit(""))
        hit, length = F.startswith("path", F.col("pattern")), F.length("pattern")
    best = paths.select("host", "path").distinct().join(r, "host").filter(hit).groupBy("host", "path").agg(F.max(F.struct(length.alias("l"), F.col("allow").alias("allow"))).alias("m"))
    return paths.join(best.select("host", "path", F.col("m.allow").alias("allowed")), ["host", "path"], "left").withColumn("allowed", F.coalesce("allowed", F.lit(True)))

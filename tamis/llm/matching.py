"""Records of one firm in two lists without a common key, by loopy belief propagation over candidate pairs.

Candidates share a key: the core of the name (also with one letter left out), the site, or the shop on a shared site. A pair's
evidence is a sum of log likelihood ratios over name, site, country and region. The pairs are the variables of a factor graph:
every directory record allows at most one of its pairs, and every entity makes two records of one and the same list unlikely.
Factors and pairs exchange messages through joins until they stand still; the marginals are the confidences.
"""

from __future__ import annotations

import unicodedata
from urllib.parse import unquote, urlsplit

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tamis.llm.addresses import one_slip, slips
from tamis.llm.addressparse import country_code
from tamis.session import broadcast_if_small, checkpoint

#: Log likelihood ratios of what two records say; the prior is that of a pair that shares a key.
PRIOR = -4.0
NAME = {"same": 5.0, "alias": 4.5, "short": 4.0, "slip": 4.0, "slips": 2.5, "part": 1.0, "other": -3.0}
SITE = {"same": 7.0, "shop": 5.0, "other": -5.0, "unknown": 0.0}
COUNTRY = {"same": 1.5, "other": -9.0, "unknown": 0.0}
REGION = {"same": 2.0, "other": -5.0, "unknown": 0.0}
#: What a slip loses where another candidate bears the very name and nothing speaks against it: whoever writes a firm's name right
#: hasn't meant another.
BESIDE = 3.0
#: How much likelier than not at all a second record of one list is for an entity; most rounds, and the change below which a
#: message stands still; log odds up to which a pair only weighs upon others without taking part in the exchange.
TWICE, ROUNDS, STILL, WEAK = 0.3, 100, 1e-3, -5.0
#: Names on a site from which it counts as shared, and entities under a key, or of equal odds for a record, beyond which they are counted, not paired one by one.
SHARED, CROWD = 20, 50

#: What firms of the trade put around their names, and before or after them in their hosts.
TRADE = set(
    "coffee coffees roaster roasters roastery roasting roasted company co kaffee kaffeerosterei kaffees rosterei koffie koffiebranderij branderij caffe torrefazione cafe cafes especialidad tostadores tostador tostaderia"
    " torrefacteur torrefacteurs torrefaction brulerie kaffe kafferosteri rosteri 커피 로스터스 珈琲 コーヒー specialty speciality ltd llc inc gmbh limited corp sl srl ab bv sarl online only the studio de and und".split()
)
_FRONT = ("shop.", "www.", "store.", "drink", "get", "try", "my")
_BACK = ("roasters", "coffee", "roasting", "roastery", "kaffee", "cafe")


def fold(text: str | None) -> str:
    t = unicodedata.normalize("NFKC", text or "").lower().replace("ß", "ss")
    return unicodedata.normalize("NFC", "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c) or c in "゙゚"))


def name_core(name: str | None) -> str:
    """Letters and digits of a name without trade words, legal forms, brackets and a trailing state."""
    t = regex.sub(r"\(.*?\)|（.*?）", " ", name or "")
    t = regex.sub(r"\s[-–]\s[\p{L} .]+$", "", t)
    words = [w for w in regex.split(r"[^\p{L}\p{N}]+", regex.sub(r"['’`]", "", fold(t))) if w]
    return "".join(w for w in words if w not in TRADE)


def name_bag(name: str | None) -> str:
    """The words of a name's core in their order of letters after a #, without possessive s; '' if there is but one."""
    t = regex.sub(r"\(.*?\)|（.*?）|\s[-–]\s[\p{L} .]+$", " ", name or "")
    t = regex.sub(r"['’`]s(?![\p{Ll}])|['’`]", " ", t)
    t = regex.sub(r"(?<=\p{Ll})(?=\p{Lu}\p{Ll})", " ", t)
    words = sorted({w for w in regex.split(r"[^\p{L}\p{N}]+", fold(t)) if w} - TRADE)
    return "#" + "".join(words) if len(words) > 1 else ""


def site(url: str | None) -> tuple[str, str]:
    """(host, letters of the last part of the path) of a URL with or without scheme."""
    u = (url or "").strip().lower()
    if not u:
        return "", ""
    try:
        parts = urlsplit(u if "//" in u else "//" + u)
        host = (parts.hostname or "").rstrip(".")
    except ValueError:
        return "", ""
    last = [x for x in unquote(parts.path).split("/") if x]
    return host.removeprefix("www."), regex.sub(r"[^\p{L}\p{N}]+", "", fold(last[-1])) if last else ""


def bare_host(host: str) -> str:
    """A host's name without its end, and without the words that shops put in front of theirs."""
    h = host.rsplit(".", 1)[0] if "." in host else host
    for front in _FRONT:
        if h.startswith(front) and len(h) > len(front) + 4:
            h = h[len(front) :]
            break
    return h


def host_core(host: str) -> str:
    h = bare_host(host).removeprefix("the")
    for _ in range(2):
        for back in _BACK:
            if h.endswith(back) and len(h) > len(back) + 4:
                h = h[: -len(back)]
    return regex.sub(r"[^\p{L}\p{N}]+", "", h)


def profiles(rows: DataFrame, key: str, aliases: str | None, listed: str | None) -> DataFrame:
    """id, listed, core, bag, host, bare, from_host, path, country, region, others of each record."""

    def run(batches):
        for pdf in batches:
            out = []
            for i, name, url, country, region, extra, of in zip(*(pdf[c] for c in ("id", "name", "url", "country", "region", "aliases", "listed"))):
                text = lambda x: x if isinstance(x, str) else None
                host, path = site(text(url))
                others = sorted({c for a in (extra if extra is not None else []) if len(c := name_core(text(a))) > 1})
                out.append((i, text(of) or "", name_core(text(name)), name_bag(text(name)), host, bare_host(host), host_core(host), path.removeprefix("the"), country_code(text(country)) or "", fold(text(region)).strip(), others))
            yield pd.DataFrame(out, columns=["id", "listed", "core", "bag", "host", "bare", "from_host", "path", "country", "region", "others"])

    some = rows.select(
        F.col(key).cast("string").alias("id"), "name", F.col("website_url").alias("url"), "country", "region",
        F.col(aliases).alias("aliases") if aliases else F.lit(None).cast("array<string>").alias("aliases"), F.col(listed).alias("listed") if listed else F.lit(None).cast("string").alias("listed"),
    ).filter("id is not null")
    return some.dropDuplicates(["id"]).mapInPandas(run, "id string, listed string, core string, bag string, host string, bare string, from_host string, path string, country string, region string, others array<string>")


def _keys(e: DataFrame, d: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, k, bare) of entities and of directory records, a row for each key; bare is the site of keys that are sites.

    Names of up to three letters are keys as they are, longer ones with one letter left out as well. Keys are hashes: whoever
    meets by a clash is told apart by the evidence.
    """
    key = lambda kind, *cols: F.xxhash64(F.lit(kind), *cols)

    def keyed(t: DataFrame, names: Column) -> DataFrame:
        name = F.col("name")
        spelled = F.when(F.length(name) > 3, slips(name)).otherwise(F.array(F.concat(F.lit("="), name)))
        none = F.lit(None).cast("string").alias("bare")
        by_name = t.withColumn("name", F.explode(F.array_distinct(names))).filter("name != '' and name != '#'").withColumn("slip", F.explode(spelled)).select("id", key("n", "slip").alias("k"), none)
        by_site = t.filter("host != '' and not shared").select("id", key("h", "bare").alias("k"), "bare")
        by_shop = t.filter("shared and path != ''").select("id", key("s", "host", "path").alias("k"), none)
        return by_name.unionByName(by_site).unionByName(by_shop).distinct()

    every = F.array(F.col("core"), F.col("bag"), F.when(~F.col("shared"), F.col("from_host")), F.when(F.col("shared"), F.col("path")))
    return keyed(e, every), keyed(d, F.concat(every, "others"))


def candidates(e: DataFrame, d: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((e, d) of entities and directory records that share a key, (d, rest) with what a record's unpaired rivals weigh).

    Where more than CROWD entities share a key, those that are alike in all that is evidence, but for own sites, are counted and
    judged as one against each record that has the key. All of odds above one become pairs, unless more than CROWD weigh the
    same for the record: none of them can be above one half, as even those that other records claim keep TWICE of their odds.
    These and the odds below one have no pair, but count against the record by their sum.
    """
    ek, dk = _keys(e, d)
    crowd = broadcast_if_small(checkpoint(ek.groupBy("k").agg(F.count("*").alias("m")).filter(F.col("m") > CROWD).select("k")))
    direct = ek.join(crowd, "k", "left_anti").select(F.col("id").alias("e"), "k").join(dk.join(crowd, "k", "left_anti").select(F.col("id").alias("d"), "k"), "k").select("e", "d").distinct()
    direct = checkpoint(direct)

    # an own site that a record has as well is a key; any other is another site, whichever it is
    own, shop = (F.col("host") != "") & ~F.col("shared"), F.when(F.col("shared"), F.col("host"))
    alike = F.xxhash64("core", "bag", own, shop, F.when(F.col("shared"), F.col("path")), "country", "region")
    kinds = e.select("id", alike.alias("kind"))
    members = checkpoint(ek.join(crowd, "k", "left_semi").join(kinds, "id"))
    groups = members.groupBy("k", "kind").agg(F.count("*").alias("m"), F.min("id").alias("one"), F.coalesce(F.max("bare"), F.lit("")).alias("bare"))
    # a group that shares several keys with a record is met once, where most of it are
    asked = dk.drop("bare").join(crowd, "k", "left_semi").join(groups, "k").groupBy(F.col("id").alias("d"), "kind", "bare").agg(F.max(F.struct("m", "k", "one")).alias("g")).select("d", "kind", "bare", "g.*")
    asked = checkpoint(asked.withColumn("e", F.xxhash64("kind", "bare")))
    faces = asked.select("one", F.col("bare").alias("face"), "e").distinct().dropDuplicates(["e"]).join(e.withColumnRenamed("id", "one"), "one")
    faces = faces.withColumn("bare", F.when(F.col("face") != "", F.col("face")).otherwise("|")).withColumn("id", F.col("e")).select(*e.columns)
    judged = asked.join(evidence(asked.select("e", "d"), faces, d).select("e", "d", "u"), ["e", "d"])
    # what has a pair by another key isn't counted again
    paired = direct.join(kinds.withColumnRenamed("id", "e"), "e").groupBy("d", "kind").agg(F.count("*").alias("had"))
    judged = judged.join(paired, ["d", "kind"], "left").withColumn("m", F.greatest(F.col("m") - F.coalesce("had", F.lit(0)), F.lit(0)))
    judged = judged.withColumn("ties", F.sum("m").over(Window.partitionBy("d", "u")))
    judged = checkpoint(judged.select("d", "k", "kind", "m", "u", ((F.col("u") > 0) & (F.col("ties") <= CROWD)).alias("pair")))
    pairs = judged.filter("pair and m > 0").select("d", "k", "kind").join(members.select(F.col("id").alias("e"), "k", "kind"), ["k", "kind"]).select("e", "d")
    return direct.unionByName(pairs).distinct(), judged.filter("not pair").groupBy("d").agg(F.sum(F.col("m") * F.exp(F.least("u", F.lit(40.0)))).alias("rest"))


def evidence(pairs: DataFrame, e: DataFrame, d: DataFrame) -> DataFrame:
    """e, d, listed, u, exact, near: the log odds of each pair on its own, and whether it bears the very name or one that slips."""
    left = e.select(*[F.col(c).alias("e_" + c) for c in e.columns if c != "listed"])
    right = d.select(*[F.col(c).alias("d_" + c) for c in d.columns])
    p = pairs.join(left, F.col("e") == F.col("e_id")).join(right, F.col("d") == F.col("d_id"))
    some = lambda names: F.array_distinct(F.filter(names, lambda x: x.isNotNull() & ~x.isin("", "#")))
    long = lambda names: F.filter(names, lambda x: F.length(x) > 3)
    all_said = some(F.concat(F.array(F.col("d_core"), F.col("d_bag"), F.when(F.col("d_shared"), F.col("d_path")), F.when(~F.col("d_shared"), F.col("d_from_host"))), "d_others"))
    all_known = some(F.array(F.col("e_core"), F.col("e_bag"), F.when(F.col("e_shared"), F.col("e_path"))))
    said, known = long(all_said), long(all_known)
    anyof = lambda test: F.exists(said, lambda x: F.exists(known, lambda y: test(x, y)))
    kind = (
        F.when((F.col("d_core") == F.col("e_core")) & (F.col("e_core") != ""), "same")
        .when(F.arrays_overlap(said, known), "alias")
        .when(F.arrays_overlap(all_said, all_known), "short")
        .when(anyof(one_slip), "slip")
        .when(anyof(lambda x, y: (F.levenshtein(x, y) <= 2) & (F.length(y) > 8)), "slips")
        .when((F.length("d_core") > 4) & (F.startswith("e_core", F.col("d_core")) | F.endswith("e_core", F.col("d_core"))), "part")
        .otherwise("other")
    )
    # a record whose shop is spelled as its name hasn't slipped in the name
    meant = F.col("d_shared") & (F.col("d_path") == F.col("d_core")) & ~F.arrays_overlap(all_said, all_known)
    kind = F.when(meant, "other").otherwise(kind)
    own = (F.col("e_host") != "") & (F.col("d_host") != "") & ~F.col("e_shared") & ~F.col("d_shared")
    shops = F.col("e_shared") & F.col("d_shared") & (F.col("e_host") == F.col("d_host")) & (F.col("e_path") != "")
    of = lambda test, weights: F.when(test, weights["same"]).otherwise(weights["other"])
    where = F.when(own, of(F.col("e_bare") == F.col("d_bare"), SITE)).when(shops, F.when(F.col("e_path") == F.col("d_path"), SITE["shop"]).otherwise(SITE["unknown"])).otherwise(SITE["unknown"])
    country = F.when((F.col("e_country") != "") & (F.col("d_country") != ""), of(F.col("e_country") == F.col("d_country"), COUNTRY)).otherwise(COUNTRY["unknown"])
    region = F.when((F.col("e_region") != "") & (F.col("d_region") != ""), of(F.col("e_region") == F.col("d_region"), REGION)).otherwise(REGION["unknown"])
    weigh = F.create_map(*[F.lit(x) for item in NAME.items() for x in item])
    return p.select("e", "d", F.col("d_listed").alias("listed"), kind.alias("kind"), (where + country + region).alias("more")).select(
        "e", "d", "listed", (F.lit(PRIOR) + weigh[F.col("kind")] + F.col("more")).alias("u"), F.col("kind").isin("same", "alias").alias("exact"), F.col("kind").isin("slip", "slips").alias("near")
    )


def beside_exact(pairs: DataFrame) -> DataFrame:
    """e, d, listed, u: slips of a record lose BESIDE where another of its pairs is exact and likelier than not on its own."""
    firm = pairs.filter("exact and u > 0").select("d").distinct().withColumn("firm", F.lit(True))
    return pairs.join(firm, "d", "left").select("e", "d", "listed", (F.col("u") - F.when(F.col("near") & F.coalesce("firm", F.lit(False)), BESIDE).otherwise(0.0)).alias("u"))


def _odds(c: Column) -> Column:
    return F.exp(F.least(c, F.lit(40.0)))


def propagate(pairs: DataFrame) -> DataFrame:
    """e, d, confidence, settled: the marginals of ``pairs`` (e, d, listed, u, rest) under the two kinds of factors.

    ``rest`` are the odds of rivals without a pair, 0 if left out. Pairs up to WEAK send no messages of their own; their odds are
    part of their record's rest. Pairs that have neither record nor entity in common with another have nothing to exchange. All
    others exchange messages until none moves by STILL; settled is false for those that still moved after ROUNDS.
    """
    if "rest" not in pairs.columns:
        pairs = pairs.withColumn("rest", F.lit(0.0))
    pairs = checkpoint(pairs.select("e", "d", "listed", "u", "rest"))
    weak = pairs.filter(F.col("u") <= WEAK)
    light = weak.groupBy("d").agg(F.sum(F.exp("u")).alias("light"))
    strong = pairs.filter(F.col("u") > WEAK).join(light, "d", "left").withColumn("rest", F.col("rest") + F.coalesce("light", F.lit(0.0))).drop("light")
    by_d = strong.groupBy("d").agg(F.count("*").alias("nd"))
    by_e = strong.groupBy("e", "listed").agg(F.count("*").alias("ne"))
    strong = checkpoint(strong.join(by_d, "d").join(by_e, ["e", "listed"]).withColumn("alone", (F.col("nd") == 1) & (F.col("ne") == 1)).drop("nd", "ne"))
    done = strong.filter("alone").select("e", "d", "listed", "u", "rest", (-F.log1p("rest")).alias("a"), F.lit(0.0).alias("b"), F.lit(True).alias("settled"))
    p = strong.filter("not alone").select("e", "d", "listed", "u", "rest", F.lit(0.0).alias("a"), F.lit(0.0).alias("b"), F.lit(False).alias("settled"))
    for n in range(ROUNDS):
        to_d = p.groupBy("d").agg(F.sum(_odds(F.col("u") + F.col("b"))).alias("sd"))
        p1 = p.join(to_d, "d").withColumn("a1", -F.log1p(F.col("rest") + F.greatest(F.col("sd") - _odds(F.col("u") + F.col("b")), F.lit(0.0)))).drop("sd")
        to_e = p1.groupBy("e", "listed").agg(F.sum(_odds(F.col("u") + F.col("a1"))).alias("se"))
        p1 = p1.join(to_e, ["e", "listed"]).withColumn("se", F.greatest(F.col("se") - _odds(F.col("u") + F.col("a1")), F.lit(0.0)))
        p1 = p1.withColumn("b1", 0.5 * F.col("b") + 0.5 * F.log((1 + TWICE * F.col("se")) / (1 + F.col("se"))))
        moved = F.greatest(F.abs(F.col("a1") - F.col("a")), F.abs(F.col("b1") - F.col("b")))
        p = p1.select("e", "d", "listed", "u", "rest", F.col("a1").alias("a"), F.col("b1").alias("b"), (moved < STILL).alias("settled"))
        p = checkpoint(p)  # each round reads the one before four times
        if n % 2 and p.filter("not settled").isEmpty():
            break
    s = done.unionByName(p)
    # what a weak pair is left with by the others of its record and its entity
    at_d = s.groupBy("d").agg(F.sum(_odds(F.col("u") + F.col("b"))).alias("sd"))
    at_e = s.groupBy("e", "listed").agg(F.sum(_odds(F.col("u") + F.col("a"))).alias("se"))
    w = weak.join(light, "d").join(at_d, "d", "left").join(at_e, ["e", "listed"], "left").na.fill(0.0, ["sd", "se"])
    w = w.withColumn("a", -F.log1p(F.col("rest") + F.greatest(F.col("light") - F.exp("u"), F.lit(0.0)) + F.col("sd"))).withColumn("b", F.log((1 + TWICE * F.col("se")) / (1 + F.col("se")))).withColumn("settled", F.lit(True))
    all_pairs = s.unionByName(w.select(*s.columns))
    return all_pairs.select("e", "d", (1 / (1 + F.exp(-(F.col("u") + F.col("a") + F.col("b"))))).alias("confidence"), "settled")


def matched(entities: DataFrame, directory: DataFrame) -> DataFrame:
    """entity_id, directory_id, confidence, settled of every candidate pair; settled is false where messages still moved.

    A missing attribute is no evidence. Records with a null id are left out, repeated ids count once. A name that consists of
    trade words only is no key and no evidence for a name. Of the tables only id, name, website_url, country and region, and of
    the directory aliases and source_profile, are read.
    """
    e, d = profiles(entities, "id", None, None), profiles(directory, "directory_id", "aliases", "source_profile")
    # numbers stand for the ids from here on, which are long
    e, d = (checkpoint(t.withColumnRenamed("id", "own_id").withColumn("id", F.monotonically_increasing_id())) for t in (e, d))
    # a site is shared if very many names are on it, or if two have a page there that is called as they are
    named = F.count_distinct(F.when((F.col("path") == F.col("core")) & (F.col("core") != ""), F.col("core")))
    hosts = e.select("host", "core", "path").unionByName(d.select("host", "core", "path")).filter("host != ''").distinct().groupBy("host").agg(F.count_distinct("core").alias("m"), named.alias("named"))
    hosts = hosts.filter((F.col("m") >= SHARED) | (F.col("named") >= 2)).select("host", F.lit(True).alias("shared"))
    hosts = broadcast_if_small(checkpoint(hosts))
    known, listed = e.select(F.col("id").alias("e"), F.col("own_id").alias("entity_id")), d.select(F.col("id").alias("d"), F.col("own_id").alias("directory_id"))
    e, d = (checkpoint(t.drop("own_id").join(hosts, "host", "left").withColumn("shared", F.coalesce("shared", F.lit(False)))) for t in (e, d))
    pairs, rest = candidates(e, d)
    scored = beside_exact(checkpoint(evidence(pairs, e, d))).join(rest, "d", "left").withColumn("rest", F.coalesce("rest", F.lit(0.0)))
    return propagate(scored).join(known, "e").join(listed, "d").select("entity_id", "directory_id", "confidence", "settled")


def found(entities: DataFrame, directory: DataFrame, least: float = 0.5) -> DataFrame:
    """entity_id, directory_id of the pairs above ``least``, of which a directory record has at most one."""
    m = matched(entities, directory).filter(F.col("confidence") > least)
    return m.groupBy("directory_id").agg(F.max(F.struct("confidence", "entity_id")).alias("m")).select(F.col("m.entity_id").alias("entity_id"), "directory_id")

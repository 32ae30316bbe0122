"""How a coffee was processed, by what its labels, attributes, title and description say.

The process is what a labelled line says, else a given attribute, else named methods, else a distinctive word of the title; only
there methods are looked for, since descriptions speak of natural sweetness and honey. Everything is built-in SQL over arrays of
clauses and lines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Methods and the folded words that name them.
METHODS = {
    "washed": r"\b(?:washed|lavado|lavada|lave|gewaschen)\b",
    "natural": r"\b(?:natural|naturel|naturale|naturals)\b",
    "honey": r"\b(?:honey|miel)\b",
    "wet_hulled": r"\b(?:wet[ -]hulled|giling basah)\b",
    "anaerobic": r"\b(?:anaerobic|anaerobico|anaerobica|anaerob|anaerobe|anaeroben)\b",
    "aerobic": r"\b(?:aerobic|aerobico|aerobica|aerob)\b",
    "carbonic_maceration": r"\b(?:carbonic maceration|maceracion carbonica|maceration carbonique)\b",
    "lactic_fermentation": r"\b(?:lactic|lactico|lactica|lactique)\b",
    "thermal_shock": r"\bthermal shock\b",
}
#: Methods that a title may name by itself, labels of lines, words that deny or leave open.
TITLE = r"\b(?:anaerobic|carbonic maceration|thermal shock)\b"
LABELS = r"(?:coffee\s+)?(?:process(?:ing)?(?:\s+method)?|processing_method|proceso|procesamiento|aufbereitung|verarbeitung|m[eé]thode de traitement)"
NOT = r"\b(?:not|no|non|without|never|sin|nicht)"
DOUBT = r"\b(?:maybe|possibly|unknown|uncertain)\b|\?"
COFERMENT = r"\b(?:co|ko)[\s-]?ferment\w*"

_ACCENTS = ("áàâäãéèêëíìîïóòôöõúùûüçñ‐‑‒–—", "aaaaaeeeeiiiiooooouuuucn-----")
_ANY = "|".join(f"(?:{p})" for p in METHODS.values())
_DENIED = (
    NOT + r"(?:[ -]+(?:actually|necessarily|really|ever|fully|been)){0,2}[ -]*$"
    rf"|{NOT}[ -]+(?:{_ANY})(?:\s*(?:and|or|y|und|/)\s*(?:{_ANY}))*\s*(?:and|or|y|und|/)\s*$|\b(?:instead of|rather than)\s*$"
)


def fold(text: Column) -> Column:
    """Lower case without the accents of European languages, dashes of one kind; '' for null."""
    return F.translate(F.lower(F.coalesce(text, F.lit(""))), *_ACCENTS)


def clauses(text: Column) -> Column:
    """Folded clauses of a text."""
    return F.split(fold(text), r"[,;.!?()]|\b(?:but|however|yet|sondern|pero)\b")


def _affirmed(clause: Column, pattern: str) -> Column:
    return clause.rlike(pattern) & ~F.regexp_extract(clause, rf"^(.*?)(?:{pattern})", 1).rlike(_DENIED)


def _some(cs: Column, pattern: str) -> Column:
    return F.exists(cs, lambda c: _affirmed(c, pattern))


def methods(text: Column) -> Column:
    """The methods that a text names without denying them, in fixed order; empty for null and where the text is in doubt."""
    # the clauses are bound once, however many methods are asked for
    hits = F.transform(F.array(clauses(text)), lambda cs: F.array_compact(F.array(*[F.when(_some(cs, p), F.lit(k)) for k, p in METHODS.items()])))
    return F.when(fold(text).rlike(DOUBT), F.array().cast("array<string>")).otherwise(F.element_at(hits, 1))


def lines(text: Column) -> Column:
    """Lines that say something, blanks made one."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\r?\n"), lambda x: F.trim(F.regexp_replace(x, r"[\s\x{00A0}]+", " "))), lambda x: ~F.lower(x).isin("", "null", "unknown", "n/a"))


def labelled(text: Column) -> Column:
    """What stands behind a label for the process, in its line or in one of the two after it; null if nothing does."""
    own = lambda x: F.trim(F.regexp_extract(x, rf"(?i)^{LABELS}\s*(?::|[-–—])\s*(.*)$", 1))
    ahead = lambda x: F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"^\s*[:\-–—]\s*", ""))

    def said(ls: Column) -> Column:
        value = lambda x, i: F.when(x.rlike(rf"(?i)^{LABELS}(?:\s*(?::|[-–—]).*|\s*)$"), F.coalesce(F.nullif(own(x), F.lit("")), F.nullif(ahead(F.get(ls, i + 1)), F.lit("")), F.nullif(ahead(F.get(ls, i + 2)), F.lit(""))))
        return F.get(F.filter(F.transform(ls, value), lambda v: v.isNotNull() & ~v.rlike(r"(?i)^(?:country|origin|variet|altitude|notes|roast)")), 0)

    return F.left(F.element_at(F.transform(F.array(lines(text)), said), 1), F.lit(400))


def coferment_claims(text: Column, source: str) -> Column:
    """array<struct<source, quote, value>>: sentences that say a coffee is co-fermented, or that it isn't.

    Questions, and what only can or could be, say nothing; neither does a comparison with others.
    """
    sentences = F.flatten(F.transform(lines(text), lambda x: F.split(x, r"(?<=[.!?])\s*")))

    def claim(s: Column) -> Column:
        f = fold(s)
        lead = F.right(F.regexp_extract(f, rf"^(.*?){COFERMENT}", 1), F.lit(80))
        says = f.rlike(COFERMENT) & ~s.contains("?") & ~lead.rlike(r"\b(?:can|could|might|may|possibly|unlike)(?:\s+\w+){0,4}\s*$")
        denied = f.rlike(NOT + r"(?:[ -]+\w+){0,3}[ -]+(?:co|ko)[ -]?ferment") & ~f.rlike(r"\bnot (?:only|just|merely)[ -]+(?:co|ko)[ -]?ferment")
        return F.when(says, F.struct(F.lit(source).alias("source"), s.alias("quote"), (~denied).alias("value")))

    return F.array_compact(F.transform(sentences, claim))


def coferment(text: Column) -> Column:
    """True or false where a text says one of them, null where it says nothing or both."""
    return F.element_at(F.transform(F.array(coferment_claims(text, "text")), _verdict), 1)


def _verdict(claims: Column) -> Column:
    yes, no = F.exists(claims, lambda c: c["value"]), F.exists(claims, lambda c: ~c["value"])
    return F.when(yes & ~no, True).when(no & ~yes, False)


def ingredients(text: Column, given: Column | None = None) -> Column:
    """Distinct materials that a text says a coffee was fermented with, and those given; notes of taste are none."""
    found = F.transform(lines(text), lambda x: F.regexp_extract(x, r"(?i)\b(?:co[\s‐-―-]?ferment\w*|ferment(?:ed|ation))\s+(?:together\s+)?(?:with|using)\s+([^.;\n]{1,160})", 1))
    found = F.filter(found, lambda x: (x != "") & ~x.rlike(r"(?i)\b(?:notes|tastes|flavou?r|aroma|reminiscent)\b"))
    parts = F.flatten(F.transform(found, lambda x: F.split(x, r"(?i),|\s+and\s+|\s*&\s*")))
    every = parts if given is None else F.concat(parts, F.coalesce(given, F.array().cast("array<string>")))
    every = F.filter(F.transform(every, lambda x: F.trim(x)), lambda x: (x != "") & (F.length(x) <= 80) & ~x.rlike(r"(?i)^(?:yes|no|true|false|coffee(?: cherries| pulp| mucilage)?|mucilage)$"))
    return F.aggregate(every, F.array().cast("array<string>"), lambda acc, x: F.when(F.exists(acc, lambda y: fold(y) == fold(x)), acc).otherwise(F.array_append(acc, x)))


def facts(title: Column, attribute: Column, description: Column, named: Column | None = None, declared: Column | None = None, materials: Column | None = None) -> Column:
    """struct<process, source, methods, is_coferment, ingredients, claims, conflict>.

    ``named`` are methods of structured data, ``declared`` its flag for co-fermentation ('true', 'yes', 'false', 'no'; else
    nothing), ``materials`` its list of what was added. Null texts say nothing. Ingredients are told only where the coffee is
    co-fermented; where claims contradict each other is_coferment is null and conflict true.
    """
    label = labelled(description)
    given = F.trim(attribute)
    given = F.when(~F.lower(given).isin("", "null", "unknown", "n/a"), F.regexp_replace(given, r"\s+", " "))
    listed = F.lit(None).cast("string") if named is None else F.nullif(F.array_join(named, " / "), F.lit(""))
    word = F.nullif(F.regexp_extract(title, rf"(?i)({TITLE})", 1), F.lit(""))
    distinctive = F.when(_some(clauses(title), TITLE), word)
    process = F.coalesce(label, given, listed, distinctive)
    source = F.when(label.isNotNull(), "label").when(given.isNotNull(), "attribute").when(listed.isNotNull(), "structured").when(distinctive.isNotNull(), "title")
    claims = F.concat(coferment_claims(process, "process"), coferment_claims(title, "title"), coferment_claims(description, "description"))
    if declared is not None:
        flag = F.when(F.lower(declared.cast("string")).isin("true", "yes"), True).when(F.lower(declared.cast("string")).isin("false", "no"), False)
        claims = F.concat(claims, F.array_compact(F.array(F.when(flag.isNotNull(), F.struct(F.lit("structured").alias("source"), declared.cast("string").alias("quote"), flag.alias("value"))))))
    bound = F.transform(F.array(F.struct(process.alias("process"), source.alias("source"), claims.alias("claims"))), lambda b: F.struct(
        b["process"].alias("process"), b["source"].alias("source"), methods(b["process"]).alias("methods"), _verdict(b["claims"]).alias("is_coferment"),
        F.when(_verdict(b["claims"]), ingredients(description, materials)).otherwise(F.array().cast("array<string>")).alias("ingredients"),
        b["claims"].alias("claims"), (F.exists(b["claims"], lambda c: c["value"]) & F.exists(b["claims"], lambda c: ~c["value"])).alias("conflict"),
    ))
    return F.element_at(bound, 1)

"""One quantity out of fields, text and source notes that use different units.

Everything is built-in SQL: mentions of a quantity are taken out of text by ``regexp_extract_all``, number words and
unit spellings are normalised by joins with constant alias tables, and ``value * factor + shift`` gives the common unit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.session import broadcast_if_small

#: unit: (dimension, system, factor, shift) to the common unit of the dimension (gram, millilitre, piece).
UNITS = {
    "mg": ("mass", "metric", "0.001", "0"),
    "g": ("mass", "metric", "1", "0"),
    "dag": ("mass", "metric", "10", "0"),
    "kg": ("mass", "metric", "1000", "0"),
    "oz": ("mass", "imperial", "28.349523125", "0"),
    "lb": ("mass", "imperial", "453.59237", "0"),
    "ml": ("volume", "metric", "1", "0"),
    "cl": ("volume", "metric", "10", "0"),
    "l": ("volume", "metric", "1000", "0"),
    "floz": ("volume", "imperial", "29.5735295625", "0"),
    "piece": ("count", "metric", "1", "0"),
}

#: Spellings in lower case, without a trailing dot.
ALIASES = {
    "mg": "mg milligram milligrams milligramm milligrammes milligrammi miligramos",
    "g": "g gr grs gm gms gram grams gramm gramme grammes grammi grammo gramo gramos grama gramas 그램 グラム 克",
    "dag": "dag dkg deka dekagramm dekagram decagram decagrams",
    "kg": "kg kgs kilo kilos kilogram kilograms kilogramm kilogramme kilogrammes kilogrammi chilo chili chilogrammo chilogrammi kilogramo kilogramos quilo quilos 킬로 킬로그램 キロ キログラム 公斤",
    "oz": "oz ozs ounce ounces unze unzen once onces oncia once onza onzas 온스 オンス",
    "lb": "lb lbs pound pounds pfund livre livres libra libras libbra libbre 파운드 ポンド",
    "ml": "ml milliliter milliliters millilitre millilitres",
    "cl": "cl centiliter centilitre",
    "l": "l lt liter liters litre litres litro litros",
    "floz": "floz",
    "piece": "each piece pieces pcs stk can cans capsule capsules pod pods bottle bottles sachet sachets drip",
}

#: Number words before a unit, in the languages of the feeds.
WORDS = {
    "0.25": "¼|quarter|a quarter|cuarto de|un cuarto de|ein viertel|un quarto di|kwart|een kwart|ett kvarts",
    "0.5": "½|half|half a|a half|mezzo|medio|meio|demi|un demi|ein halbes|halbes|een halve|halve|ett halvt|halvt",
    "0.75": "¾|three quarter|three quarters",
    "1": "a|an|one|un|une|uno|una|ein|eine|een|ett|en|um|uma",
    "2": "two|deux|dos|due|zwei|twee|två|dois",
    "3": "three|trois|tres|tre|drei|drie|três",
    "4": "four|quatre|cuatro|quattro|vier|fyra|quatro",
    "5": "five|cinq|cinco|cinque|fünf|vijf|fem",
    "6": "six|seis|sei|sechs|zes|sex",
    "7": "seven",
    "8": "eight|huit|ocho|otto|acht|åtta|oito",
    "9": "nine",
    "10": "ten|dix|diez|dieci|zehn|tien|tio|dez",
    "12": "twelve|douze|doce|dodici|zwölf|twaalf|tolv|doze",
    "16": "sixteen",
}


def _alternation(words: list[str]) -> str:
    return "|".join(sorted({w.replace(".", "\\.") for w in words}, key=lambda w: (-len(w), w)))


UNIT_PATTERN = _alternation([a for k, v in ALIASES.items() if k != "piece" for a in v.split()])
WORD_PATTERN = _alternation([w for v in WORDS.values() for w in v.split("|")])
NUMBER_PATTERN = rf"[0-9]{{1,3}}(?: [0-9]{{3}})+|[0-9]+ [0-9]/[0-9]+|[0-9]+ ?[½¼¾]|[0-9]+/[0-9]+|[0-9]*[.,][0-9]+|[0-9]+|{WORD_PATTERN}"
#: A mention: number, optional blank or hyphen, unit. No look-around, so other SQL engines can run it too.
MENTION = rf"(?:^|[^a-z0-9.,/])({NUMBER_PATTERN})[ -]?({UNIT_PATTERN})(?:[^a-z]|$)"

#: What stands in titles and holds digits but no quantity: roast dates, lots, altitudes, prices, cups.
NOISE = (
    r"\(roast date[^)]*\)|otl [0-9]+/[0-9]+|(?:makes|~) ?[0-9]+ cups|[$€£¥₩] ?[0-9.,]+|"
    r"(?:lot|batch|no\.|loring s|bc-|sl)\s*[0-9.]+|[0-9]{3,4} ?m(?:[^a-z0-9]|$)"
)
PACKS = r" x ?[0-9]|[0-9] ?x |[0-9]x[0-9]|×|[0-9][- ]?packs?(?:[^a-z]|$)|(?:bags|packs|pouches|packets|boxes|sachets|beutel|sachets) of |(?:set|box|pack|case|lot) of [0-9]|[^a-z]each(?:[^a-z]|$)"
SUM = r"\+| plus "
RANGE = r"[0-9] ?[-–—] ?[0-9]+(?:[.,][0-9]+)? ?(?:g|gr|kg|oz|lb|lbs)(?:[^a-z]|$)"
VOLUME = r"(?:[0-9½¼¾] ?-?)(?:ml|cl|l|lt|liters?|litres?|fl\.? ?oz)(?:[^a-z]|$)"
PIECES = r"[0-9]+ (?:cans?|capsules?|pods?|bottles?|drip bags?|sachets?|pieces?|pcs|stk)(?:[^a-z]|$)"

WIDE_FROM, WIDE_TO = "０１２３４５６７８９ｇｋｌｍｏｚｂ．，－", "0123456789gklmozb.,-"


def unit_rows() -> list[tuple[str, str, str, str, str, str]]:
    """(alias, unit, dimension, system, factor, shift)."""
    return [(a, k, *UNITS[k]) for k, v in ALIASES.items() for a in dict.fromkeys(v.split())]


def unit_table(spark: SparkSession) -> DataFrame:
    """The alias table; a constant of under 200 rows."""
    df = spark.createDataFrame(unit_rows(), "alias string, unit string, dimension string, system string, factor string, shift string")
    return df.withColumns({c: F.col(c).cast("decimal(20,9)") for c in ("factor", "shift")})


def word_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w, n) for n, v in WORDS.items() for w in v.split("|")], "word string, number string")


def clean_text(text: Column) -> Column:
    """Lower case, narrow digits and letters, plain blanks, no noise, slashes after letters set apart."""
    t = F.lower(F.translate(F.replace(text, F.lit("㎏"), F.lit("kg")), WIDE_FROM, WIDE_TO))
    t = F.regexp_replace(t, "[    \t\r\n]", " ")
    t = F.regexp_replace(t, NOISE, " ")
    return F.regexp_replace(t, r"([^0-9 ])([/–—])", "$1 $2 ")


def number_value(raw: Column, word: Column, unit: Column) -> Column:
    """Decimal of a number as written; 1 200, 2 1/2, 2½, 1/2, .5, 0,5 and number words."""
    dec = lambda c: c.cast("decimal(18,6)")
    part = lambda p, i: F.regexp_extract(raw, p, i)
    half = F.when(raw.contains("½"), 0.5).when(raw.contains("¼"), 0.25).when(raw.contains("¾"), 0.75).cast("decimal(18,6)")
    thousands = raw.rlike(r"^[1-9][0-9]{0,2}[.,][0-9]{3}$") & unit.isin("g", "mg")
    denominator = F.nullif(dec(part(r"/([0-9]{1,4})$", 1)), F.lit(0).cast("decimal(18,6)"))
    return (
        F.when(word.isNotNull(), dec(word))
        .when(raw.rlike(r"^[0-9]{1,3}( [0-9]{3})+$") & (F.length(raw) < 13), dec(F.replace(raw, F.lit(" "), F.lit(""))))
        .when(raw.rlike(r"^[0-9]{1,6} [0-9]/[0-9]{1,4}$"), dec(part("^([0-9]+) ", 1)) + (dec(part(" ([0-9])/", 1)) / denominator).cast("decimal(18,6)"))
        .when(raw.rlike(r"^[0-9]{1,6} ?[½¼¾]$"), dec(part("^([0-9]+)", 1)) + half)
        .when(raw.rlike(r"^[0-9]{1,6}/[0-9]{1,4}$"), (dec(part("^([0-9]+)/", 1)) / denominator).cast("decimal(18,6)"))
        .when(thousands, dec(F.regexp_replace(raw, "[.,]", "")))
        .when(raw.rlike(r"^[0-9]{0,9}([.,][0-9]{1,9})?$"), dec(F.concat(F.lit("0"), F.replace(raw, F.lit(","), F.lit(".")))))
    )


#: Words of a source's note that make its plain field worthless as a net quantity: gross weights and defaults.
NOT_NET = r"includ|inclu|compren|imball|verpack|emball|packag|gross|brutto|lordo|tare|default|every variant|not maintained|no weights"
#: Words that say the note speaks of the plain field and not of the field with a unit.
NOTE_FIELD = r"(?:column|field|campo|feld|champ|spalte|called) (?:called )?grams|^grams|campo grams|[^a-z]grams:"


def source_units(feeds: DataFrame, source: str = "source", note: str = "export_note") -> DataFrame:
    """source, weight_unit_default, plain_unit, plain_ok out of the notes the sources wrote about their numbers.

    A note that names one unit besides the name of the plain field gives the default unit; if it speaks of the plain field,
    the unit is that field's. Null, empty or silent notes give no default and a plain field in its own unit.
    """
    spark = feeds.sparkSession
    text = F.lower(F.coalesce(F.col(note), F.lit("")))
    base = feeds.select(F.col(source).alias("source"), text.alias("note")).dropDuplicates(["source"])
    words = F.array_distinct(F.concat(F.split("note", r"[^\p{L}]+"), F.regexp_extract_all("note", F.lit("(킬로그램|킬로|그램|グラム|キロ)"))))
    said = (
        base.withColumn("word", F.explode(words))
        .join(F.broadcast(unit_table(spark).filter("dimension = 'mass'").select(F.col("alias").alias("word"), "unit")), "word")
        .filter("length(word) > 1 and not (unit = 'lb' and word = 'livre')")
        .groupBy("source")
        .agg(F.collect_set("unit").alias("units"))
    )
    field = F.col("note").rlike(NOTE_FIELD)
    other = F.array_except(F.col("units"), F.array(F.lit("g")))
    named = F.when(F.size(other) == 1, other[0]).when((F.size(other) == 0) & F.array_contains("units", "g"), F.lit("g"))
    return base.join(said, "source", "left").select(
        "source",
        F.when(~field, named).alias("weight_unit_default"),
        F.coalesce(F.when(field, named), F.lit("g")).alias("plain_unit"),
        (~F.col("note").rlike(NOT_NET)).alias("plain_ok"),
    )


def net_quantities(
    rows: DataFrame, feeds: DataFrame, *, key: str = "id", source: str = "source", text: str = "title", plain: str = "grams", value: str = "weight", unit: str = "weight_unit", tolerance: float = 0.02
) -> DataFrame:
    """(key, net): one row per distinct key whose mass is known, in whole grams, halves up.

    Text decides; else ``value`` in its unit or the source's default; else ``plain`` in the source's unit for it. Number of
    packs, sums, ranges, several different masses, volumes and pieces in the text give no row, whatever the fields say. A mass
    stated in both systems counts by its metric figure, if the two agree within ``tolerance``. Null and zero are no value;
    null or empty text states nothing; unknown units and sources without a feed give no unit. Null keys are dropped, rows of
    one key are taken together, and only the named columns are read, so other columns may have any names.
    """
    spark = rows.sparkSession
    units, words = F.broadcast(unit_table(spark)), F.broadcast(word_table(spark))
    src = broadcast_if_small(source_units(feeds))
    base = rows.select(
        F.col(key).alias("k"), F.col(source).alias("source"), F.coalesce(clean_text(F.col(text)), F.lit("")).alias("t"), F.col(plain).alias("plain"), F.col(value).alias("v"),
        F.regexp_replace(F.lower(F.trim(F.coalesce(F.col(unit), F.lit("")))), r"\.$", "").alias("u"),
    ).filter("k is not null")
    t = F.col("t")
    base = base.withColumn("refused", t.rlike(PACKS) | t.rlike(SUM) | t.rlike(RANGE) | t.rlike(VOLUME) | t.rlike(PIECES))
    said = F.regexp_extract_all(t, F.lit(MENTION), F.lit(0))
    base = base.withColumn("m", F.explode_outer(said))
    raw, alias = F.regexp_extract("m", MENTION, 1), F.regexp_extract("m", MENTION, 2)
    base = base.withColumns({"raw": raw, "alias": alias}).join(words.select(F.col("word").alias("raw"), "number"), "raw", "left")
    base = base.join(units.select("alias", F.col("unit").alias("tu"), F.col("system").alias("ts"), (F.col("factor")).alias("tf"), F.col("shift").alias("to")), "alias", "left")
    number = number_value(F.col("raw"), F.col("number"), F.col("tu"))
    base = base.withColumn("said", (number * F.col("tf") + F.col("to")).cast("decimal(24,6)"))
    base = base.join(src, "source", "left")
    lookup = lambda name, of: units.filter("dimension = 'mass'").select(F.col(of).alias(name), F.col("factor").alias(name + "_f"), F.col("shift").alias(name + "_o"))
    constant = spark.createDataFrame([(k, v[2], v[3]) for k, v in UNITS.items() if v[0] == "mass"], "unit string, f string, o string").withColumns({c: F.col(c).cast("decimal(20,9)") for c in ("f", "o")})
    default = F.broadcast(constant.select(F.col("unit").alias("weight_unit_default"), F.col("f").alias("d_f"), F.col("o").alias("d_o")))
    plains = F.broadcast(constant.select(F.col("unit").alias("plain_unit"), F.col("f").alias("p_f"), F.col("o").alias("p_o")))
    base = base.join(lookup("u", "alias"), "u", "left").join(default, "weight_unit_default", "left").join(plains, "plain_unit", "left")
    own = F.when(F.col("u") == "", F.col("d_f")).otherwise(F.col("u_f"))
    shift = F.when(F.col("u") == "", F.col("d_o")).otherwise(F.col("u_o"))
    size = F.when(F.col("v") > 0, F.col("v")).cast("decimal(18,6)")
    base = base.withColumn("weighed", (size * own + shift).cast("decimal(24,6)"))
    base = base.withColumn("plained", F.when((F.col("plain") > 0) & F.col("plain_ok"), F.col("plain").cast("decimal(18,6)") * F.col("p_f") + F.col("p_o")).cast("decimal(24,6)"))
    # a unit of another dimension in the unit field says that the thing isn't sold by mass
    base = base.withColumn("refused", F.col("refused") | ((F.col("u") != "") & F.col("u_f").isNull() & (F.col("u").isin(*[a for k in ("ml", "cl", "l", "floz", "piece") for a in ALIASES[k].split()])) & F.col("said").isNull()))
    metric, imperial = F.when(F.col("ts") == "metric", F.col("said")), F.when(F.col("ts") == "imperial", F.col("said"))
    g = base.groupBy("k").agg(
        F.max("refused").alias("refused"), F.min(metric).alias("m0"), F.max(metric).alias("m1"), F.min(imperial).alias("i0"), F.max(imperial).alias("i1"),
        F.max("weighed").alias("weighed"), F.max("plained").alias("plained"),
    )
    near = lambda a, b: F.abs(a - b) <= F.greatest(F.lit(2.0), b.cast("double") * tolerance)
    text_g = F.when((F.col("m0") == F.col("m1")) & (F.col("i0").isNull() | (near(F.col("i0"), F.col("m0")) & near(F.col("i1"), F.col("m0")))), F.col("m0")).when(
        F.col("m0").isNull() & near(F.col("i0"), F.col("i1")), F.col("i1")
    )
    stated = F.col("m0").isNotNull() | F.col("i0").isNotNull()
    net = F.when(stated, text_g).otherwise(F.coalesce("weighed", "plained"))
    return g.filter(~F.col("refused")).select(F.col("k").alias(key), F.round(net, 0).cast("bigint").alias("net")).filter("net > 0")

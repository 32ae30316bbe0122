"""Amounts written in text, with the currency they are in; a reason where none can be told."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Signs that name one currency; $ and ¥ alone don't.
SIGNS = {"US$": "USD", "CA$": "CAD", "AU$": "AUD", "NZ$": "NZD", "S$": "SGD", "C$": "CAD", "A$": "AUD", "€": "EUR", "£": "GBP", "Kč": "CZK", "₩": "KRW", "₹": "INR", "₽": "RUB", "₺": "TRY", "₫": "VND", "₪": "ILS", "₴": "UAH", "₦": "NGN"}
#: Digits behind the point of currencies that haven't two (ISO 4217), and the codes that are known.
DIGITS = {0: "BIF CLP DJF GNF ISK JPY KMF KRW PYG RWF UGX VND VUV XAF XOF XPF", 3: "BHD IQD JOD KWD LYD OMR TND"}
CODES = set("AED ARS AUD BGN BRL CAD CHF CNY COP CRC CZK DKK DOP EGP ETB EUR GBP GTQ HKD HNL HUF IDR ILS INR KES MAD MXN MYR NGN NIO NOK NZD PAB PEN PHP PKR PLN QAR RON RSD RUB SAR SEK SGD THB TRY TWD TZS UAH USD UYU ZAR".split()) | set(DIGITS[0].split()) | set(DIGITS[3].split())
#: Locales whose decimal sign is a comma; their groups are set off by a point or a blank.
COMMA = ("de", "fr", "es", "it", "pt", "nl", "sv", "da", "nb", "fi", "pl", "cs", "tr", "ru", "uk", "id", "vi", "el", "hu", "ro", "bg")
#: Fixed pattern: what may stand around an amount.
AFFIX = r"(?i)(?:(?:[A-Z]{3}|Kč|kr|R|[A-Z]{1,2}\$|[$€£¥₩₹₽₺₫฿₱₪₴₦])\s*)*(?:TTC)?"
_NUMBER = r"[0-9](?:[0-9.,'’ ]*[0-9])?"
_WIDE = ("０１２３４５６７８９．，＄￥￦－　  ", "0123456789.,$¥₩-   ")


def currency_of(text: Column, given: Column) -> tuple[Column, Column]:
    """(array of the currencies that text and field name, whether the field names none though it says something)."""
    words = F.filter(F.transform(F.regexp_extract_all(text, F.lit(r"(?i)(?:^|[^A-Za-z])([A-Z]{3})(?![A-Za-z])")), F.upper), lambda w: w.isin(*sorted(CODES)))
    table = F.create_map(*[F.lit(x) for kv in SIGNS.items() for x in kv])
    pattern = "(" + "|".join(x.replace("$", "\\$") for x in sorted(SIGNS, key=len, reverse=True)) + ")"
    signs = F.transform(F.regexp_extract_all(text, F.lit(pattern)), lambda x: F.element_at(table, x))
    g = F.trim(given)
    explicit = F.coalesce(F.when(F.upper(g).isin(*sorted(CODES)), F.upper(g)), F.try_element_at(table, g))
    bad = given.isNotNull() & (g != "") & explicit.isNull()
    return F.array_distinct(F.array_compact(F.concat(words, signs, F.array(explicit)))), bad


def amount(raw: Column, currency: Column | None = None, locale: Column | None = None) -> Column:
    """struct<amount decimal(18,3), currency, minor_units, reason> of a price as text; never fails.

    Ranges, prose, irregular groups and a single separator before three digits are refused with a reason; so are amounts finer
    than the currency and such beyond 32 bits. Without a currency the amount is given and the reason is unknown_currency.
    """
    currency = F.lit(None).cast("string") if currency is None else currency
    locale = F.lit(None).cast("string") if locale is None else locale
    t = F.trim(F.translate(F.coalesce(raw, F.lit("")), *_WIDE))
    found, bad = currency_of(t, currency)
    code = F.when(F.size(found) == 1, found[0])
    digits = F.when(code.isin(*DIGITS[0].split()), 0).when(code.isin(*DIGITS[3].split()), 3).otherwise(2)
    number = F.regexp_extract(t, f"({_NUMBER})", 1)
    prose = ~t.rlike(f"^{AFFIX}\\s*{_NUMBER}\\s*{AFFIX}$")
    grouped = number.rlike("[ '’]")
    n = F.regexp_replace(number, "[ '’]", "")
    comma = F.lower(F.regexp_extract(locale, "^([A-Za-z]{2,3})", 1)).isin(*COMMA)
    told = locale.isNotNull()
    both = n.contains(".") & n.contains(",")
    last = F.when(told, comma).when(both, F.length(F.substring_index(n, ",", -1)) < F.length(F.substring_index(n, ".", -1))).otherwise(n.contains(","))
    plain = F.when(last, F.replace(F.replace(n, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).otherwise(F.replace(n, F.lit(","), F.lit("")))
    regular = F.when(last, n.rlike(r"^[0-9]{1,3}(\.[0-9]{3})+(,[0-9]+)?$|^[0-9]+(,[0-9]+)?$")).otherwise(n.rlike(r"^[0-9]{1,3}(,[0-9]{3})+(\.[0-9]+)?$|^[0-9]+(\.[0-9]+)?$"))
    value = F.when(F.length(plain) <= 17, plain.try_cast("decimal(24,6)"))
    unit = F.element_at(F.array(F.lit(1), F.lit(10), F.lit(100), F.lit(1000)), digits + 1)
    minor = value * unit
    reason = (
        F.when((F.size(found) > 1) | bad, "conflicting_or_invalid_currency").when((t == "") | t.rlike("[-–—−+%/]"), "missing_or_range_price").when(number == "", "missing_amount")
        .when(prose, "price_prose").when(grouped & ~number.rlike(r"^[0-9]{1,3}([ '’][0-9]{3})+([.,][0-9]{1,3})?$"), "invalid_grouping")
        .when(~told & ~both & n.rlike(r"^[0-9]+[.,][0-9]{3}$"), "locale_required").when(~regular, F.when(both | told, "invalid_grouping").otherwise("invalid_amount")).when(value.isNull(), "amount_overflow")
        .when(minor != F.floor(minor), "currency_precision").when(minor > 2147483647, "amount_overflow").when(code.isNull(), "unknown_currency")
    )
    ok = reason.isNull() | (reason == "unknown_currency")
    return F.struct(F.when(ok, value).cast("decimal(18,3)").alias("amount"), F.when(reason.isNull() | (reason != "conflicting_or_invalid_currency"), code).alias("currency"), F.when(reason.isNull(), minor).cast("int").alias("minor_units"), reason.alias("reason"))

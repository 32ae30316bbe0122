"""Keys and fingerprints; all built-in hashes over JSON written without blanks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stable_key(*parts: Column | str) -> Column:
    """SHA-256 of the JSON array of the parts as strings; a null part stays null in the array."""
    cols = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.sha2(F.to_json(F.array(*cols)), 256)


def stable_uuid(*parts: Column | str) -> Column:
    """UUID with the bits of version 5 from the first 16 bytes of ``stable_key``."""
    h = stable_key(*parts)
    nibble = lambda pos: F.conv(F.substring(h, pos, 1), 16, 10).cast("int")
    variant = F.lower(F.hex((nibble(17).bitwiseAND(3)).bitwiseOR(8)))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(F.substring(variant, -1, 1), F.substring(h, 18, 3)), F.substring(h, 21, 12))


def source_key(*parts: Column) -> Column:
    """First 24 digits of the SHA-256 of the parts joined by NUL; null parts are empty."""
    return F.left(F.sha2(F.concat_ws(chr(0), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256), F.lit(24))


def row_digest(df: DataFrame, *cols: str) -> Column:
    """SHA-256 of a row as JSON, nulls written out as an array keeps them."""
    return F.sha2(F.to_json(F.array(*[F.col(c).cast("string") for c in (cols or df.columns)])), 256)


def multiset_fingerprint(df: DataFrame, *cols: str) -> DataFrame:
    """One row (rows, fingerprint) that doesn't depend on the order of rows, for tables of any size.

    The digests are summed in 32 bit pieces with map-side partial sums, so nothing is gathered in one place; two tables of the
    same rows, repeated ones included, have equal fingerprints. An empty table has 0 rows and the fingerprint of zero sums.
    """
    cols = cols or tuple(df.columns)
    d = df.select(row_digest(df, *cols).alias("d"))
    pieces = [F.coalesce(F.sum(F.conv(F.substring("d", 1 + 8 * i, 8), 16, 10).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")) for i in range(8)]
    return d.agg(F.count("*").alias("rows"), F.sha2(F.concat_ws(",", *[p.cast("string") for p in pieces]), 256).alias("fingerprint"))


def ordered_fingerprint(df: DataFrame, order: str, *cols: str) -> DataFrame:
    """One row (rows, fingerprint): SHA-256 of the row digests in the order of a key, for small tables such as ledgers."""
    d = df.select(F.struct(F.col(order).alias("o"), row_digest(df, *(cols or tuple(df.columns))).alias("d")).alias("s"))
    return d.agg(F.count("*").alias("rows"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda x: x["d"]), "\n"), 256).alias("fingerprint"))


def any_distinct(pairs: list[tuple[Column, Column]]) -> Column:
    """Whether any two columns differ, nulls being equal to nulls; never null."""
    return reduce(lambda a, b: a | b, [~x.eqNullSafe(y) for x, y in pairs])

"""Reading exports and writing versioned tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ExportError(ValueError):
    """An export that can't be read as what it claims to be."""


def infer_format(path: str) -> str:
    """csv, json or ndjson by a file's name; other names are an error."""
    end = path.lower().rsplit(".", 1)[-1]
    kinds = {"csv": "csv", "json": "json", "ndjson": "ndjson", "jsonl": "ndjson"}
    if end not in kinds:
        raise ExportError(f"unknown kind of file: {path}")
    return kinds[end]


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Names in the first line of a CSV file; empty and repeated names are an error."""
    first = spark.read.csv(path, header=False, multiLine=True, quote='"', escape='"').limit(1).collect()
    names = [(x or "").replace("﻿", "").strip() for x in first[0]] if first else []
    if any(not n for n in names):
        raise ExportError("a header is empty")
    if len(set(names)) != len(names):
        raise ExportError("two headers are equal")
    return names


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows of text columns: quoted fields with "" and line breaks, blank rows dropped, short rows filled with ''.

    Rows with too many fields are an error when read. A file without lines is a table without columns and rows.
    """
    names = csv_header(spark, path)
    if not names:
        return spark.createDataFrame([], T.StructType([]))
    width = len(names) + 1
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    raw = spark.read.csv(path, schema=schema, header=False, multiLine=True, quote='"', escape='"', mode="PERMISSIVE", enforceSchema=True)
    cols = [F.coalesce(f"c{i}", F.lit("")) for i in range(len(names))]
    head = F.lit(True)
    for c, n in zip(cols, names):
        head = head & (F.trim(F.replace(c, F.lit("﻿"), F.lit(""))) == n)
    blank = F.concat(*cols) == ""
    over = F.when(F.col(f"c{width - 1}").isNotNull(), F.raise_error(F.lit("a row has too many fields"))).otherwise(F.lit(True))
    return raw.filter(~head & ~blank).filter(over).select(*[c.alias(n) for c, n in zip(cols, names)])


def read_json_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records of a JSON export that is a list, an object with records, items or data, or one record."""
    many = T.ArrayType(schema)
    wrap = T.StructType([T.StructField(k, many) for k in ("records", "items", "data")])
    text = spark.read.text(path, wholetext=True).select(F.trim(F.replace("value", F.lit("﻿"), F.lit(""))).alias("t"))
    w = F.from_json("t", wrap)
    rows = F.when(F.startswith("t", F.lit("[")), F.from_json("t", many)).otherwise(F.coalesce(w["records"], w["items"], w["data"], F.array(F.from_json("t", schema))))
    return text.select(F.explode(rows).alias("r")).select("r.*")


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records of a file of JSON lines; a line that isn't JSON is an error when read, blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    kind = infer_format(path)
    return read_csv(spark, path) if kind == "csv" else read_json_export(spark, path, schema) if kind == "json" else read_ndjson(spark, path, schema)


def sitemap_urls(pages: DataFrame, xml: str = "body") -> DataFrame:
    """``pages`` with a row per <url>: loc, lastmod, priority, changefreq; entries without loc are dropped.

    Prefixed tags and CDATA are read too; a text without entries has no row. Built-in patterns, so broken XML gives what it has.
    """
    plain = F.regexp_replace(F.regexp_replace(F.col(xml), r"(?s)<!\[CDATA\[(.*?)\]\]>", "$1"), r"<(/?)[A-Za-z0-9]+:", "<$1")
    entry = F.regexp_extract_all(plain, F.lit(r"(?is)<url\b[^>]*>(.*?)</url\s*>"))
    field = lambda name: F.nullif(F.trim(_entities(F.regexp_extract("_e", rf"(?is)<{name}\b[^>]*>(.*?)</{name}\s*>", 1))), F.lit(""))
    rows = pages.withColumn("_e", F.explode(entry))
    return rows.withColumns({n: field(n) for n in ("loc", "lastmod", "priority", "changefreq")}).filter("loc is not null").drop("_e")


def sitemap_children(pages: DataFrame, xml: str = "body") -> DataFrame:
    """``pages`` with a row per child sitemap: loc."""
    plain = F.regexp_replace(F.regexp_replace(F.col(xml), r"(?s)<!\[CDATA\[(.*?)\]\]>", "$1"), r"<(/?)[A-Za-z0-9]+:", "<$1")
    rows = pages.withColumn("_e", F.explode(F.regexp_extract_all(plain, F.lit(r"(?is)<sitemap\b[^>]*>(.*?)</sitemap\s*>"))))
    loc = F.nullif(F.trim(_entities(F.regexp_extract("_e", r"(?is)<loc\b[^>]*>(.*?)</loc\s*>", 1))), F.lit(""))
    return rows.withColumn("loc", loc).filter("loc is not null").drop("_e")


def locations(xml: Column) -> Column:
    """All <loc> texts of an XML text, as an array."""
    return F.transform(F.regexp_extract_all(xml, F.lit(r"(?is)<(?:[a-z0-9]+:)?loc\b[^>]*>\s*(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?\s*</(?:[a-z0-9]+:)?loc\s*>")), _entities)


def _entities(c: Column) -> Column:
    for e, x in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(e), F.lit(x))
    return c


def image_kind(content: Column) -> Column:
    """png, jpeg, gif, webp or avif by a binary's first bytes; null for anything else."""
    h = F.hex(F.substring(content, 1, 16))
    return (
        F.when(F.startswith(h, F.lit("89504E470D0A1A0A")), "png").when(F.startswith(h, F.lit("FFD8FF")), "jpeg")
        .when(F.startswith(h, F.lit("474946383761")) | F.startswith(h, F.lit("474946383961")), "gif")
        .when(F.startswith(h, F.lit("52494646")) & (F.substring(h, 17, 8) == "57454250"), "webp")
        .when((F.substring(h, 9, 8) == "66747970") & F.substring(h, 17, 8).isin("61766966", "61766973"), "avif")
    )


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """path, length, kind, md5 of the files under a folder that are images."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return raw.select("path", "length", image_kind(F.col("content")).alias("kind"), F.md5("content").alias("md5")).filter("kind is not null")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of a table, in order."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    found = []
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if name.startswith("v=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")):
            found.append(int(name[2:]))
    return sorted(found)


def write_version(df: DataFrame, path: str, keep: int = 2) -> int:
    """Write a table's next version beside the current one and drop all but the last ``keep``; readers never see half a table.

    One writer at a time is assumed: Spark has no lock to offer here.
    """
    spark = df.sparkSession
    old = versions(spark, path)
    new = (old[-1] if old else 0) + 1
    df.write.mode("overwrite").parquet(f"{path}/v={new}")
    for v in old[: max(0, len(old) + 1 - keep)]:
        fs, p = _fs(spark, f"{path}/v={v}")
        fs.delete(p, True)
    return new


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    v = versions(spark, path)
    if not v:
        raise FileNotFoundError(path)
    return spark.read.parquet(f"{path}/v={version or v[-1]}")


def append_journal(df: DataFrame, path: str) -> None:
    """Append rows to a journal; the commit protocol makes a batch appear as a whole or not at all."""
    df.write.mode("append").parquet(path)

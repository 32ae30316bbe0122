"""Reading exports and sitemaps, writing versions."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamis.sources import files


def write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text, encoding="utf-8")
    return str(p)


def test_csv(spark, tmp_path):
    p = write(tmp_path, "a.csv", '﻿name,note\r\n"A ""x""","two\nlines"\r\n\r\nB\r\n,\r\nC,"a,b"\r\n')
    assert [tuple(r) for r in files.read_csv(spark, p).orderBy("name").collect()] == [('A "x"', "two\nlines"), ("B", ""), ("C", "a,b")]
    for bad in ("a,a\n1,2\n", "a,\n1,2\n"):
        with pytest.raises(files.ExportError):
            files.read_csv(spark, write(tmp_path, "b.csv", bad))
    with pytest.raises(Exception, match="too many fields"):
        files.read_csv(spark, write(tmp_path, "c.csv", "a,b\n1,2,3\n")).collect()
    assert files.read_csv(spark, write(tmp_path, "d.csv", "")).count() == 0


SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])


@pytest.mark.parametrize("text", ['[{"id":1,"name":"a"},{"id":2}]', '{"records":[{"id":1,"name":"a"},{"id":2}]}', '﻿{"data":[{"id":1,"name":"a"},{"id":2}],"total":2}'])
def test_json(spark, tmp_path, text):
    assert [tuple(r) for r in files.read_export(spark, write(tmp_path, "a.json", text), SCHEMA).collect()] == [(1, "a"), (2, None)]


def test_single_record_and_lines(spark, tmp_path):
    assert [tuple(r) for r in files.read_export(spark, write(tmp_path, "a.json", '{"id":7}'), SCHEMA).collect()] == [(7, None)]
    assert files.read_export(spark, write(tmp_path, "a.jsonl", '{"id":1}\n\n{"id":2}\n'), SCHEMA).count() == 2
    with pytest.raises(Exception):
        files.read_export(spark, write(tmp_path, "b.ndjson", '{"id":1}\n{bad\n'), SCHEMA).collect()
    with pytest.raises(files.ExportError):
        files.infer_format("a.xml")


XML = """<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" xmlns:i="x"><url><loc> https://a.example/?a=1&amp;b=2 </loc><lastmod>2026-01-01</lastmod><i:image><i:loc>https://a.example/i.png</i:loc></i:image></url>
<url><loc><![CDATA[https://a.example/c]]></loc><priority>0.5</priority></url><url><lastmod>x</lastmod></url></urlset>"""
INDEX = "<sitemapindex><sitemap><loc>https://a.example/1.xml</loc></sitemap><sitemap></sitemap></sitemapindex>"


def test_sitemaps(spark):
    df = spark.createDataFrame([(1, XML), (2, INDEX), (3, ""), (4, None), (5, "<url><loc>broken")], "page_id int, body string")
    got = files.sitemap_urls(df).orderBy("loc").collect()
    assert [(r["page_id"], r["loc"], r["lastmod"], r["priority"]) for r in got] == [(1, "https://a.example/?a=1&b=2", "2026-01-01", None), (1, "https://a.example/c", None, "0.5")]
    assert [r["loc"] for r in files.sitemap_children(df).collect()] == ["https://a.example/1.xml"]
    assert [len(r[0] or []) for r in df.orderBy("page_id").select(files.locations(F.col("body"))).collect()] == [3, 1, 0, 0, 0]


def test_images(spark, tmp_path):
    kinds = {"a.png": b"\x89PNG\r\n\x1a\n123", "b.jpg": b"\xff\xd8\xff\xe0x", "c.gif": b"GIF89a..", "d.webp": b"RIFF0000WEBPVP8 ", "e.avif": b"\0\0\0\x1cftypavif", "f.txt": b"hello", "g": b""}
    for n, b in kinds.items():
        (tmp_path / n).write_bytes(b)
    got = {r["path"].rsplit("/", 1)[1]: r["kind"] for r in files.read_images(spark, str(tmp_path)).collect()}
    assert got == {"a.png": "png", "b.jpg": "jpeg", "c.gif": "gif", "d.webp": "webp", "e.avif": "avif"}


def test_versions(spark, tmp_path):
    p = str(tmp_path / "t")
    assert files.versions(spark, p) == []
    for i in range(4):
        assert files.write_version(spark.range(i), p) == i + 1
    assert files.versions(spark, p) == [3, 4] and files.read_version(spark, p).count() == 3 and files.read_version(spark, p, 3).count() == 2
    files.append_journal(spark.range(2), str(tmp_path / "j"))
    files.append_journal(spark.range(3), str(tmp_path / "j"))
    assert spark.read.parquet(str(tmp_path / "j")).count() == 5
    with pytest.raises(FileNotFoundError):
        files.read_version(spark, str(tmp_path / "none"))

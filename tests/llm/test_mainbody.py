"""Main bodies: pages of several makes, votes of hosts, errors and broken markup."""

from tamis.llm import mainbody as M

NAMED = """<!doctype html>
<html><head><title>Kenya AA | Shop</title>
<style>.x{a:b}</style></head><body>
<div class="nav">
<a href="/">Home</a>
</div>
<div class="rte">
<h1>Kenya&nbsp;AA</h1>
<p>A long and sweet coffee,
with a <a href="/x">clean</a> end.</p>
<div class="buy">
<p>12 €</p>
<button>Add</button>
</div>
<li>Process: washed</li>
<a href="/share">Share</a>
<!-- a note
over two lines -->
</div>
<div class="foot">
<p>All rights reserved. We have roasted since the early days of this harbour, and we still do.</p>
</div>
<script>var a = "<div>";
</script>
</body></html>"""
BODY = [8, 9, 10, 15]
FLAT = "<hr>\n<a href='/'>Home</a>\n<!-- -->\n<hr>\n<b>Kenya AA</b><br>\nSweet and long.<br>\n<hr>\n[Add to cart]\n<!-- -->\n- Process: washed<br>\n<!-- -->\n<hr>\nAll rights reserved.\n<!-- -->"
SCHEMA = "page_id bigint, url string, status int, html string, primary_html string, path string, score double"


def lines(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], SCHEMA)
    out = {}
    for r in M.main_lines(df).collect():
        out.setdefault(r["page_id"], []).append(r["line_no"])
    return {k: sorted(v) for k, v in out.items()}


def test_makes_of_pages(spark):
    url = "https://a.example/products/kenya-aa-12"
    soft = NAMED.replace("<h1>Kenya&nbsp;AA</h1>", "<h1>Page not found</h1>")
    rows = [(1, url, 200, NAMED, None), (2, "https://b.example/products/kenya-aa", 200, None, FLAT), (3, url, 404, NAMED, None), (4, url, 200, soft, None), (5, url, 200, None, None), (6, url, 200, "", None), (7, url, 200, "  \n ", None), (8, None, None, NAMED, FLAT), (9, url, 200, NAMED, None), (9, url, 200, NAMED, None), (10, "::bad::", 200, "<div", None)]
    assert lines(spark, rows) == {1: BODY, 2: [5, 6, 10], 8: BODY, 9: BODY}
    assert lines(spark, []) == {}


def test_host_vote_beats_a_breadcrumb(spark):
    crumb = "<html><head><title>Kenya AA | Shop</title></head><body>\n<div class=\"top\">\n<p>Kenya AA</p>\n<p>Here we tell at length about our shop, its people, and whatever else comes to mind today.</p>\n</div>\n<div class=\"rte\">\n<h1>Kenya AA</h1>\n<p>Sweet.</p>\n</div>\n</body></html>"
    url = "https://a.example/products/kenya-aa"
    own = [(i, url, 200, NAMED, None) for i in range(6)]
    assert lines(spark, [(100, url, 200, crumb, None)])[100] == [3, 4]
    assert lines(spark, [*own, (100, url, 200, crumb, None)])[100] == [7, 8]


def test_paths(spark):
    df = spark.createDataFrame([(i, "https://a.example/products/kenya-aa", 200, NAMED.replace("rte", f"c{i}"), None, "x", 1.0) for i in range(5)], SCHEMA)
    row = M.host_paths(M.page_containers(df)).collect()
    assert [(r["host"], r["winner"], r["specific"]) for r in row] == [("a.example", ">div", False)]


def test_long_page(spark):
    page = NAMED.replace("with a", "x" * 300_000 + " with a")
    assert lines(spark, [(1, "https://a.example/products/kenya-aa", 200, page, None)]) == {1: BODY}


def test_names():
    assert M.page_names("https://a.example/products/caf%C3%A9-1", "Café | X") == {"cafe", "cafe1"}
    assert M.page_names(None, None) == set()


def test_title_that_is_not_the_heading(spark):
    page = "<html><head><title>Our best Kenya lot this year | Shop</title></head><body>\n<nav>\n<a href=\"/\">Home</a>\n</nav>\n<main>\n<h1>Kenya Kiambu AA</h1>\n<p>Sweet and long, a coffee for the morning.</p>\n</main>\n<footer>\n<p>All rights reserved. We have roasted since the early days of this harbour, and we still do.</p>\n</footer>\n</body></html>"
    assert lines(spark, [(1, "https://a.example/p/77", 200, page, None)]) == {1: [6, 7]}


def test_page_without_line_ends(spark):
    one = NAMED.replace("\n", " ")
    found = {c[0]: c for c in M.containers("https://a.example/products/kenya-aa", one)}
    assert found[">div.rte"][3] and not any("rights" in t or "Home" in t for t in found[">div.rte"][6])
    assert lines(spark, [(1, "https://a.example/products/kenya-aa", 200, one, None)]) == {1: [1]}
    two = "<div class=\"nav\"><div><a href=\"/\">Home</a></div><div>Free shipping.</div></div><div class=\"foot\"><p>All rights.</p></div>\n" + one
    assert lines(spark, [(1, "https://a.example/products/kenya-aa", 200, two, None)]) == {1: [2]}


def test_one_vote_a_page(spark):
    long = NAMED.replace("rte", "story").replace("with a", "very long words of praise. " * 400)
    rows = [(i, "https://a.example/products/kenya-aa", 200, NAMED, None) for i in range(3)] + [(9, "https://a.example/products/kenya-aa", 200, long, None)]
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], SCHEMA)
    assert [(r["winner"], r["specific"]) for r in M.host_paths(M.page_containers(df)).collect()] == [(">div.rte", True)]


def test_errors_are_learned_from_pages_of_error_statuses(spark):
    gone = "<main>\n<h1>Sivua ei ole</h1>\n<p>Palaa etusivulle ja jatka siitä.</p>\n</main>"
    rows = [(i, f"https://h{i}.example/products/x-{i}", 404, gone, None) for i in range(2)]
    rows += [(5, "https://a.example/products/y", 200, gone, None), (6, "https://a.example/products/z", 200, gone.replace("Palaa", "Maista").replace("Sivua", "Kahvia"), None)]
    assert lines(spark, rows) == {6: [2, 3]}

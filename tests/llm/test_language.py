"""Languages: exact code lengths against a plain implementation, wrong labels, mixed texts, edges."""

import math
from collections import defaultdict

import numpy as np
import pytest

from tamis.llm import language as L

S = {
    "en": ["The cherries were sorted by hand and dried for ten days.", "We roast every week and ship the orders on the next day.", "Rest the beans for a few days before you open the bag.", "With milk the taste of caramel is gone, which is a pity."],
    "de": ["Die Kirschen wurden von Hand gepflückt und zehn Tage getrocknet.", "Wir rösten jede Woche und versenden am nächsten Werktag.", "Lassen Sie die Bohnen ein paar Tage ruhen.", "Mit Milch verschwindet der Geschmack von Karamell leider."],
    "fr": ["Les cerises sont cueillies à la main puis séchées pendant dix jours.", "Nous torréfions chaque semaine et nous expédions le lendemain.", "Laissez reposer les grains quelques jours après la torréfaction.", "Avec du lait, le goût de caramel disparaît, ce qui est dommage."],
    "ko": ["잘 익은 체리를 손으로 수확하여 열흘 동안 건조했습니다.", "매주 신선하게 로스팅하여 다음 날 발송합니다.", "로스팅 후 며칠 동안 숙성한 다음에 드시는 것이 좋습니다.", "우유와 함께 마시면 캐러멜 향이 사라져서 아쉽습니다."],
}


def slow_cost(texts, text, order):
    """Bits of ``text`` by the definition."""
    count = defaultdict(lambda: defaultdict(int))
    for t in texts:
        b = b" " * order + t.encode()
        for i in range(order, len(b)):
            for k in range(order + 1):
                count[b[i - k : i]][b[i]] += 1
    bits, b = 0.0, b" " * order + text.encode()
    for i in range(order, len(b)):
        for k in range(order, -1, -1):
            c = count.get(b[i - k : i])
            if not c:
                continue
            total, distinct = sum(c.values()), len(c)
            if b[i] in c:
                bits -= math.log2(c[b[i]] / (total + distinct))
                break
            bits -= math.log2(distinct / (total + distinct))
        else:
            bits += 8
    return bits


@pytest.mark.parametrize("order", [1, 3, 4])
def test_exact_code_lengths(order):
    langs = ("en", "de", "ko")
    # one text a language, for the blanks between texts are counted as context of the next
    samples = {x: [" ".join(S[x])] for x in langs}
    trees = L.ContextTrees(samples, langs, order)
    texts = ["The bag arrived late.", "Die Tüte kam spät.", "가공 방식은 내추럴입니다.", "zzzz qqq 12", "", "x"]
    got = trees.cost(texts)
    want = [[slow_cost(samples[x], t, order) for x in langs] for t in texts]
    assert np.allclose(got, want, rtol=1e-4, atol=1e-2)


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, lang string, text string, label string, n int")


def corpus():
    rows, i = [], 0
    for lang, ss in S.items():
        for k in range(24):
            a, b, c = ss[k % 4], ss[(k + 1) % 4], ss[(k + 2) % 4]
            rows.append((i, lang if k % 8 else "en", f"{a} {b}\n{c}", "x", 1))
            i += 1
    return rows


CASES = [
    (1001, "en-GB", S["en"][0]), (1002, None, S["de"][1]), (1003, "de", S["fr"][2] + " " + S["fr"][0]), (1004, "EN_us", S["en"][1] + "\n" + S["de"][0] + " " + S["de"][2]), (1005, "", "  "), (1006, "ko", None),
    (1007, "fr", ""), (1008, "de", "12345 !!! 😀"), (1009, "ko", S["ko"][0] + S["ko"][1] + " " + S["en"][2]), (1010, "xx", S["ko"][3]), (1011, "en", (S["en"][0] + " ") * 2000), (1012, "en", S["en"][3]), (1012, "en", S["en"][3]),
]


def test_relabelled(spark):
    got = L.relabelled(docs(spark, corpus() + [(*c, "x", 1) for c in CASES]))
    found = {}
    for r in got.collect():
        found.setdefault(r["doc_id"], set()).add(r["lang"])
    assert {k: v for k, v in found.items() if k > 1000} == {1002: {"de"}, 1003: {"fr"}, 1004: {"en", "de"}, 1009: {"ko", "en"}, 1010: {"ko"}}
    # the wrong labels of the corpus itself come out too
    assert {k for k in found if k < 1000} == {i for i in range(24, 96) if i % 24 % 8 == 0}


def test_segments(spark):
    rows = L.language_segments(docs(spark, corpus() + [(*c, "x", 1) for c in CASES])).filter("doc_id = 1004").orderBy("segment_no").collect()
    assert [r["lang"] for r in rows] == ["en", "de"]
    text = CASES[3][2]
    assert text[rows[0]["start_char"] : rows[0]["end_char"]].strip() == S["en"][1] and rows[1]["end_char"] == len(text)
    assert all(0.9 < r["confidence"] <= 1 for r in rows)


def test_empty(spark):
    assert L.relabelled(docs(spark, [])).count() == 0
    assert L.relabelled(docs(spark, [(1, None, "some words here", "x", 1)])).count() == 1


def test_switch_price():
    bits = np.array([[10, 60], [60, 50], [10, 60]], np.float32)
    assert L.best_path(bits) == [0, 0, 0]
    assert L.best_path(bits, switch=2) == [0, 1, 0]

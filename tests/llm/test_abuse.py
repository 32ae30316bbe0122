"""Abuse classifier: normalisation, held-out accuracy, thresholds, edges."""

import random

import numpy as np
import pytest

from tamis.llm import abuse


def test_tokens_see_through_disguise():
    same = abuse.tokens("what an idiot")
    for s in ("What an 1d10t!", "what an i.d.i.o.t", "WHAT AN IDIIIIOT", "what an id​iot", "what an i d i o t", "what an іdіоt", "ｗｈａｔ ａｎ ｉｄｉｏｔ"):
        assert abuse.tokens(s) == same, s
    assert abuse.tokens("황금알") == ["황금", "금알"] and abuse.tokens("😀 !!") == []
    assert abuse.tokens("12 3") == ["#", "#"]


GOOD = ["the beans were roasted on {} and ship tomorrow", "we like {} with milk in the morning", "my grinder is stock and {} tastes fine", "that damned {} lid is stuck again", "this {} is a killer, it slays", "rest {} for some days before you brew"]
BAD = {
    "abusive": ["you {} are an idiot and nobody likes you", "shut your mouth you {} moron", "i know where you live {} and will hurt you"],
    "hateful": ["people of that religion {} belong in a cage", "women {} are too stupid to run a roastery", "those foreigners {} are vermin, drive them out"],
    "sexual": ["naked singles {} wait for you tonight", "send me nudes {} and i tell you what i do in bed", "she undressed him {} and moaned on the bar"],
}
WORDS = ["kenya", "the filter", "this lot", "again", "today", "your coffee", "the bag", "peru", "always", "that espresso"]


def corpus(n, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        parts = [r.choice(GOOD).format(r.choice(WORDS)) for _ in range(r.randint(1, 5))]
        y = [0, 0, 0]
        for c, (name, forms) in enumerate(BAD.items()):
            if r.random() < 0.15:
                parts.insert(r.randrange(len(parts) + 1), r.choice(forms).format(r.choice(WORDS)))
                y[c] = 1
        out.append((i, ". ".join(parts) + ".", y))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    rows, r = corpus(700, 1), random.Random(2)
    docs = [(i, t, "en", f"s{i % 3}", 1) for i, t, _ in rows]
    docs += [(10_001, None, "en", "s0", 1), (10_002, "", "en", "s0", 1), (10_003, "   ", "en", None, 1), (10_004, GOOD[0] * 3000 + ". " + BAD["sexual"][0], "en", "s1", 1), (10_005, "😀😀", "en", "s1", 1)]
    flip = lambda y: 1 - y if r.random() < 0.06 else y
    rated = [(i, f"r{k}", *[flip(v) for v in y], "x") for i, _, y in rows[:450] for k in range(1 + i % 2)]
    rated += [(10_001, "r0", 1, 0, 0, "x"), (77_777, "r0", 1, 1, 1, "x"), (5, "r9", None, None, None, "x")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, score int")
    return d, spark.createDataFrame(rated, "doc_id bigint, rater string, abusive int, hateful int, sexual int, text string"), {i: y for i, _, y in rows}


@pytest.fixture(scope="module")
def scores(tables):
    docs, ratings, _ = tables
    return abuse.scored(docs, ratings).cache()


def test_held_out_accuracy(tables, scores):
    docs, _, truth = tables
    got = {r["doc_id"]: r for r in scores.collect()}
    assert len(got) == docs.count()
    for c, name in enumerate(abuse.CATEGORIES):
        held = [i for i in truth if i >= 450]
        hit = sum(got[i][name] and truth[i][c] for i in held)
        p, n = sum(bool(got[i][name]) for i in held), sum(truth[i][c] for i in held)
        assert hit / max(p, 1) > 0.85 and hit / n > 0.85, (name, hit, p, n)
    for i in (10_001, 10_002, 10_003, 10_005):
        assert not any(got[i][c] for c in abuse.CATEGORIES) and got[i]["sexual_score"] == 0
    assert got[10_004]["sexual"]


def test_found_and_rates(tables, scores, monkeypatch):
    docs, ratings, _ = tables
    f = abuse.found(docs, ratings)
    flags = {(r["doc_id"], c) for r in scores.collect() for c in abuse.CATEGORIES if r[c]}
    assert f.columns == ["doc_id", "category"] and {tuple(r) for r in f.collect()} == flags
    monkeypatch.setattr(abuse, "scored", lambda *_: scores)
    rates = abuse.source_rates(docs, ratings)
    assert {r["source"] for r in rates.collect()} == {"s0", "s1", "s2", None} and all(0 <= r["abusive_rate"] <= 1 for r in rates.collect())


def test_without_ratings(tables):
    docs, ratings, _ = tables
    assert abuse.found(docs.limit(20), ratings.filter("false")).count() == 0
    assert abuse.found(docs.filter("false"), ratings.filter("false")).count() == 0


def test_trained_once_and_kept(tables, tmp_path, monkeypatch):
    docs, ratings, _ = tables
    model = abuse.train(docs.sparkSession, docs, ratings)
    monkeypatch.setattr(abuse, "_trained", lambda *_: pytest.fail("trained again"))
    assert abuse.train(docs.sparkSession, docs, ratings) is model
    model.save(str(tmp_path / "m"))
    again = abuse.Model.load(str(tmp_path / "m"))
    assert abuse.found(docs, None, again).count() == abuse.found(docs, None, model).count()


def test_gradient_free_learning_on_one_word():
    r = abuse.Reader()
    texts = [("good day", 0), ("foul day", 1), ("good night", 0), ("foul night", 1)] * 20
    docs = [[r.sentence(t)] for t, _ in texts]
    y = np.array([[v, 0, 0] for _, v in texts], np.float32)
    z = abuse.TextCnn().fit(docs, y, epochs=60).logits(docs)
    assert ((z[:, 0] > 0) == y[:, 0]).all()


def test_texts_are_read_as_documents():
    r = abuse.Reader()
    texts = [t for _, t, _ in corpus(40, 9)] + [None, "", "😀", corpus(40, 9)[0][1]]
    m = abuse.TextCnn()
    z, worded = m.text_logits(r, texts)
    assert np.allclose(z[worded], m.logits([r.document(t) for t in texts if t and r.document(t)]), atol=1e-4) and worded.tolist() == [True] * 40 + [False] * 3 + [True]
    assert m.text_logits(r, [])[0].shape == (0, 3)


def test_sample_is_bounded_and_weighted(tables):
    docs, ratings, _ = tables
    rows = abuse.rated_sample(docs, ratings, 100)
    some = [r for r in rows if max(r[3:]) > 0]
    assert len(rows) <= 100 and 40 <= len(some) <= 50
    assert len({r[2] for r in some}) == 1 and some[0][2] > 1
    assert all(r[2] == 1 for r in abuse.rated_sample(docs, ratings, 10_000))


def test_weighted_threshold():
    z, y = np.array([[3.0, 0, 0], [2.0, 0, 0], [1.0, 0, 0], [0.0, 0, 0]]), np.array([[1.0, 0, 0], [1, 0, 0], [0, 0, 0], [1, 0, 0]])
    langs = np.array(["a"] * 4, dtype=object)
    assert abuse.thresholds(z, y, langs, np.array([1, 1, 9.0, 1]))[""][0] == 1.5
    assert abuse.thresholds(z, y, langs, np.array([1, 1, 0.1, 1]))[""][0] <= 0

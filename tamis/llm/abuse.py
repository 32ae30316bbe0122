"""Abusive, hateful and sexual content by a convolutional text classifier in numpy.

Words (pairs of letters in Korean, Japanese and Chinese) are hashed into a table of embeddings; filters of several widths run
over each sentence, the largest response of each filter over the document feeds one logistic output per category. Training
runs on a bounded sample of rated documents: the models of three folds are trained in Spark tasks, their predictions for the
documents they haven't seen correct the targets where raters err and set a threshold per language and category; the final
model is trained on the corrected targets.
"""

from __future__ import annotations

import hashlib
import pickle
import unicodedata
import zlib

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.llm import language

CATEGORIES = ("abusive", "hateful", "sexual")
#: Bounds of the training sample (documents, and characters from which a document is none of them), and the model's shape.
TRAIN_DOCS, TRAIN_CHARS, FOLDS, EPOCHS, STEPS = 12_000, 20_000, 3, 12, 2_500
#: Logits by which a held-out prediction may move a target.
SOFTEN = 2.0
BUCKETS, DIM, WIDTHS, FILTERS = 1 << 15, 48, (1, 2, 3), 32

_INVISIBLE = regex.compile(r"[\p{Cf}\p{Mn}]+")
_SPACED = regex.compile(r"(?<![\p{L}\p{N}])(?:[\p{L}][ .\-_*]){3,}[\p{L}](?![\p{L}\p{N}])")
_SEPARATOR = regex.compile(r"[ .\-_*]")
_TOKEN = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}ー]+|[\p{Hangul}]+|(?:(?![\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}])[\p{L}\p{N}$@€|])(?:(?:(?![\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}])[\p{L}\p{N}$@€|!*'’])*(?:(?![\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}])[\p{L}\p{N}$@€|*]))?")
_CJK = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}ー]")
_RUN = regex.compile(r"(.)\1+")
_CODE = regex.compile(r"(?=.*\d)[0-9a-f]{6,}")
#: Digits and signs that stand for letters.
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "$": "s", "@": "a", "!": "i", "|": "l", "€": "e", "’": "'", "v": "u"})

#: Cyrillic and Greek letters that look like Latin ones.
TWINS = str.maketrans("авсеһіјкмноорԛѕтухуѵԝԁӏαβεικνορτυχ", "abcehijkmhoopqstyxyvwdlabeiknoptux")


def tokens(sentence: str) -> list[str]:
    """Normalised words of a sentence: one spelling for look-alike digits, stretched and spaced letters."""
    s = _INVISIBLE.sub("", unicodedata.normalize("NFKC", sentence).lower()).translate(TWINS)
    s = _INVISIBLE.sub("", unicodedata.normalize("NFD", s)) if s.isascii() is False and not _CJK.search(s) else s
    s = _SPACED.sub(lambda m: _SEPARATOR.sub("", m[0]), s)
    out = []
    for w in _TOKEN.findall(s):
        if _CJK.match(w):
            out += [w[i : i + 2] for i in range(len(w) - 1)] or [w]
        elif w.isdigit() or _CODE.fullmatch(w):
            out.append("#")
        else:
            out.append(_RUN.sub(r"\1", w.translate(LOOKALIKES).replace("*", "")))
    return out


class Reader:
    """Texts as bucket arrays, one per sentence, with memories of words and sentences bounded in size."""

    def __init__(self):
        self.buckets: dict[str, int] = {}

    def sentence(self, s: str) -> np.ndarray:
        if len(self.buckets) > 500_000:
            self.buckets.clear()
        b = self.buckets
        out = []
        for t in tokens(s):
            i = b.get(t)
            if i is None:
                i = b[t] = 1 + zlib.crc32(t.encode("utf-8", "surrogatepass")) % (BUCKETS - 1)
            out.append(i)
        return np.array(out, np.int32)

    def document(self, text: str) -> list[np.ndarray]:
        return [x for x in (self.sentence(text[a:b]) for a, b in language.sentences(text)) if len(x)]


def _layout(docs: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all sentences with two empty places after each, and where each document begins."""
    gap = np.zeros(max(WIDTHS) - 1, np.int32)
    parts, starts, n = [], [], 0
    for d in docs:
        starts.append(n)
        for s in d or [np.zeros(1, np.int32)]:
            parts += [s, gap]
            n += len(s) + len(gap)
    return np.concatenate(parts), np.array(starts)


class TextCnn:
    """Embedding table, filters and outputs; ``fit`` with Adam on soft targets, ``logits`` of documents."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        f = lambda *shape, scale: (r.standard_normal(shape) * scale).astype(np.float32)
        self.p = {"e": f(BUCKETS, DIM, scale=0.3), "w": f(FILTERS * len(WIDTHS), len(CATEGORIES), scale=0.1), "b": np.full(len(CATEGORIES), -2, np.float32)}
        for k in WIDTHS:
            self.p[f"f{k}"], self.p[f"g{k}"] = f(k * DIM, FILTERS, scale=0.5 / np.sqrt(k * DIM) * 2), np.zeros(FILTERS, np.float32)
        self.p["e"][0] = 0

    def _pool(self, seq: np.ndarray, starts: np.ndarray, where: bool):
        """Largest response of every filter in each document, and at which position."""
        x = self.p["e"][seq]
        pooled, places = [], []
        ends = np.r_[starts[1:], len(seq)]
        n = len(seq)
        # all filters' parts at once: one product instead of one for each width and offset
        parts = x @ np.concatenate([self.p[f"f{k}"][j * DIM : (j + 1) * DIM] for k in WIDTHS for j in range(k)], axis=1)
        nothing, at = seq == 0, 0
        for k in WIDTHS:
            h = parts[:, at : at + FILTERS].copy()
            for j in range(1, k):
                h[: n - j] += parts[j:, at + j * FILTERS : at + (j + 1) * FILTERS]
            at += k * FILTERS
            h[nothing] = -1e9  # a window that begins between sentences would reach into the next one
            m = np.maximum.reduceat(h, starts, axis=0)
            if where:
                places.append(np.stack([starts[i] + h[starts[i] : ends[i]].argmax(axis=0) for i in range(len(starts))]))
            pooled.append(m + self.p[f"g{k}"])
        return np.maximum(np.concatenate(pooled, axis=1), 0), places

    def logits(self, docs: list[list[np.ndarray]], batch: int = 256) -> np.ndarray:
        out = [np.zeros((0, len(CATEGORIES)), np.float32)]
        for i in range(0, len(docs), batch):
            pooled, _ = self._pool(*_layout(docs[i : i + batch]), where=False)
            out.append(pooled @ self.p["w"] + self.p["b"])
        return np.concatenate(out)

    def text_logits(self, reader: Reader, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(logits, whether a text has a word) of texts: a sentence that occurs again is read and filtered once."""
        place: dict[str, int] = {}
        words: list[np.ndarray] = []
        of: list[list[int]] = []
        for t in texts:
            ids = []
            for a, b in language.sentences(t) if t else []:
                s = t[a:b].strip()
                if s not in place:
                    place[s] = len(words)
                    words.append(reader.sentence(s))
                if len(words[place[s]]):
                    ids.append(place[s])
            of.append(ids)
        pooled = [np.zeros((1, FILTERS * len(WIDTHS)), np.float32)]
        for i in range(0, len(words), 1024):
            pooled.append(self._pool(*_layout([[w] if len(w) else [] for w in words[i : i + 1024]]), where=False)[0])
        pooled = np.concatenate(pooled)
        flat = np.array([j + 1 for ids in of for j in ids or [-1]], np.int64)
        starts = np.cumsum([0, *(max(1, len(ids)) for ids in of)])[:-1]
        best = np.maximum.reduceat(pooled[flat], starts, axis=0) if len(of) else np.zeros((0, pooled.shape[1]), np.float32)
        return best @ self.p["w"] + self.p["b"], np.array([bool(ids) for ids in of], bool)

    def fit(self, docs: list[list[np.ndarray]], targets: np.ndarray, epochs: int | None = None, batch: int = 16, rate: float = 8e-3, decay: float = 1e-4, seed: int = 1) -> TextCnn:
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, n = 0, len(docs)
        epochs = epochs or max(EPOCHS, STEPS * batch // max(n, batch))
        for epoch in range(epochs):
            lr = rate * (1 - epoch / epochs * 0.8)
            for ids in np.array_split(r.permutation(n), max(1, n // batch)):
                if not len(ids):
                    continue
                step += 1
                seq, starts = _layout([docs[i] for i in ids])
                seq = np.where(r.random(len(seq)) < 0.1, 0, seq)
                pooled, places = self._pool(seq, starts, where=True)
                keep = (r.random(pooled.shape) < 0.7).astype(np.float32) / 0.7
                z = (pooled * keep) @ self.p["w"] + self.p["b"]
                d = (1 / (1 + np.exp(-z)) - targets[ids]) / len(ids)
                g = {"w": (pooled * keep).T @ d, "b": d.sum(axis=0)}
                back = (d @ self.p["w"].T) * keep * (pooled > 0)
                rows, grads = [], []
                live = [np.nonzero(back[:, i * FILTERS : (i + 1) * FILTERS]) for i in range(len(WIDTHS))]
                for i, k in enumerate(WIDTHS):
                    q = back[:, i * FILTERS : (i + 1) * FILTERS]
                    at = places[i]
                    gf = np.zeros_like(self.p[f"f{k}"])
                    for j in range(k):
                        tok = seq[np.minimum(at + j, len(seq) - 1)]
                        gf[j * DIM : (j + 1) * DIM] = np.einsum("bf,bfd->df", q, self.p["e"][tok])
                        doc, of = live[i]
                        rows.append(tok[doc, of])
                        grads.append(q[doc, of, None] * self.p[f"f{k}"][j * DIM : (j + 1) * DIM].T[of])
                    g[f"f{k}"], g[f"g{k}"] = gf, q.sum(axis=0)
                rows, grads = np.concatenate(rows), np.concatenate(grads)
                if len(rows):
                    by = np.argsort(rows, kind="stable")
                    rows, grads = rows[by], grads[by]
                    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
                    u, ge = rows[first], np.add.reduceat(grads, first, axis=0)
                else:
                    u, ge = rows, grads
                c1, c2 = 1 - 0.9**step, 1 - 0.999**step
                for k, v in g.items():
                    v = v + decay * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * v
                    s[k] = 0.999 * s[k] + 0.001 * v * v
                    self.p[k] -= (lr * (m[k] / c1) / (np.sqrt(s[k] / c2) + 1e-8)).astype(np.float32)
                m["e"][u] = 0.9 * m["e"][u] + 0.1 * ge
                s["e"][u] = 0.99 * s["e"][u] + 0.01 * ge * ge
                self.p["e"][u] -= lr * m["e"][u] / (np.sqrt(s["e"][u]) + 1e-6)
                self.p["e"][0] = 0
        return self


def rated_sample(docs: DataFrame, ratings: DataFrame, limit: int = TRAIN_DOCS) -> list[tuple]:
    """(text, raters, weight, mean rating of each category) of at most ``limit`` rated documents, in the order of a hash.

    Half of the bound is for documents that some rater found something in, since those are few and tell most; the weight of a
    document is how many of its kind one stands for. Documents of TRAIN_CHARS characters or more are no examples. Only the
    chosen ids are sent to where the documents are.
    """
    mean = [F.avg(F.col(c).cast("double")).alias(c) for c in CATEGORIES]
    rated = ratings.groupBy("doc_id").agg(F.count("*").alias("n"), *mean).filter(" and ".join(f"{c} is not null" for c in CATEGORIES)).withColumn("any", F.greatest(*CATEGORIES) > 0)
    size = {r[0]: r[1] for r in rated.groupBy("any").agg(F.count("*")).collect()}
    room = {True: max(limit // 2, limit - size.get(False, 0)), False: max(limit // 2, limit - size.get(True, 0))}
    parts = [rated.filter(F.col("any") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(room[k]) for k in (True, False)]
    first = F.broadcast(parts[0].unionByName(parts[1]))  # at most ``limit`` rows
    texts = docs.select("doc_id", "text").filter((F.length(F.trim("text")) > 0) & (F.length("text") < TRAIN_CHARS))
    rows = texts.join(first, "doc_id").select("doc_id", "text", "n", "any", *CATEGORIES).collect()
    weight = {k: max(1.0, size.get(k, 0) / room[k]) for k in (True, False)}
    return [(r["text"], r["n"], weight[r["any"]], *(r[c] for c in CATEGORIES)) for r in sorted(rows, key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["text"]))]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def thresholds(logits: np.ndarray, targets: np.ndarray, langs: np.ndarray, weights: np.ndarray, prior: float = 12.0) -> dict[str, np.ndarray]:
    """Logit from which a category counts, by language and, under '', for all; each row counts by its weight.

    A threshold has the best F1 over held-out predictions; a language's own is drawn towards the common one by the share of
    ``prior`` in prior plus its positives.
    """

    def best(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
        o = np.argsort(-z, kind="stable")
        f1 = 2 * np.cumsum((y * w)[o]) / (np.cumsum(w[o]) + (y * w).sum())
        # the middle of the range of equally good cuts
        top = np.flatnonzero(f1 >= f1.max() - 1e-9)
        i, j = o[top[-1]], o[min(top[-1] + 1, len(z) - 1)]
        return float((z[i] + z[j]) / 2)

    common = np.array([best(logits[:, c], targets[:, c], weights) if targets[:, c].sum() >= 3 else 0.0 for c in range(len(CATEGORIES))])
    out = {"": common}
    for lang in set(langs.tolist()):
        of = langs == lang
        own = common.copy()
        for c in range(len(CATEGORIES)):
            n = targets[of, c].sum()
            if n >= 4:
                own[c] = (n * best(logits[of, c], targets[of, c], weights[of]) + prior * common[c]) / (n + prior)
        out[lang] = own
    return out


class Model:
    """What scoring needs: the context trees, the network and the thresholds. ``save`` and ``load`` keep it as one file."""

    def __init__(self, trees: language.ContextTrees, net: TextCnn, limits: dict[str, np.ndarray]):
        self.trees, self.net, self.limits = trees, net, limits
        every = np.array(list(limits.values()))
        self.least, self.most = every.min(axis=0), every.max(axis=0)

    def save(self, path: str) -> None:
        with open(path, "wb") as f:
            pickle.dump(self, f)

    @staticmethod
    def load(path: str) -> Model:
        with open(path, "rb") as f:
            return pickle.load(f)


#: Models of this session by their training sample, so that scores, flags and rates of the same ratings train once.
_MODELS: dict[str, Model] = {}


def train(spark: SparkSession, docs: DataFrame, ratings: DataFrame, reuse: bool = True) -> Model:
    """The model of the rated sample; with ``reuse`` a sample met before in this session isn't trained on again.

    A category that nobody has found in the sample is never flagged.
    """
    sample, examples = rated_sample(docs, ratings), language.examples(docs)
    seal = hashlib.sha256(repr((sample, examples)).encode("utf-8", "surrogatepass")).hexdigest()
    if seal not in _MODELS or not reuse:
        while len(_MODELS) >= 2:
            _MODELS.pop(next(iter(_MODELS)))
        _MODELS[seal] = _trained(spark, sample, language.grow(examples))
    return _MODELS[seal]


def _trained(spark: SparkSession, sample: list[tuple], trees: language.ContextTrees) -> Model:
    raters = np.array([r[1] for r in sample], np.float64)
    weights = np.array([r[2] for r in sample], np.float64)
    y = np.array([r[3:] for r in sample], np.float32).reshape(-1, len(CATEGORIES))
    never = np.full(len(CATEGORIES), np.inf)
    if not y.any():
        return Model(trees, TextCnn(), {"": never})
    reader = Reader()
    read = [reader.document(t) for t, *_ in sample]
    langs = np.array([main_language(trees, s) for s in language.segments(trees, [r[0] for r in sample])], dtype=object)
    shared = spark.sparkContext.broadcast(read)
    said = np.log((y * 0.8 + 0.1) / (0.9 - y * 0.8)) * np.minimum(raters, 3)[:, None]  # a rater errs about once in ten times
    z, _ = _held_out(spark, shared, y)
    # the held-out prediction is a further witness. It may soften a target but not turn it, since it can't know a form that only
    # held-out documents have
    soft = _sigmoid(2 * said + np.clip(z, -SOFTEN, SOFTEN)).astype(np.float32)
    again, net = _held_out(spark, shared, soft, final=True)
    limits = thresholds(again, (said + np.clip(z + again, -5, 5) > 0).astype(np.float64), langs, weights)
    shared.unpersist()
    return Model(trees, net, {k: np.where(y.any(axis=0), v, never) for k, v in limits.items()})


def _held_out(spark: SparkSession, shared, targets: np.ndarray, final: bool = False) -> tuple[np.ndarray, TextCnn | None]:
    """(logits of every training document by the model of the fold that doesn't hold it, the model of all of them if ``final``).

    One task trains one fold, and one more the final model beside them.
    """
    y = spark.sparkContext.broadcast(targets)

    def fold(batches):
        docs = shared.value
        for pdf in batches:
            for k in pdf["fold"]:
                if k == FOLDS:
                    net = TextCnn(seed=3).fit(docs, y.value)
                    yield pd.DataFrame({"i": np.array([-1]), "net": [pickle.dumps(net.p)], **dict.fromkeys(CATEGORIES, 0.0)})
                    continue
                held = np.arange(len(docs)) % FOLDS == k
                model = TextCnn(seed=7 + int(k)).fit([docs[i] for i in np.flatnonzero(~held)], y.value[~held])
                at = np.flatnonzero(held)
                z = model.logits([docs[i] for i in at])
                yield pd.DataFrame({"i": at, "net": None, **{c: z[:, n].astype(float) for n, c in enumerate(CATEGORIES)}})

    parts = FOLDS + final
    folds = spark.range(0, parts, 1, parts).withColumnRenamed("id", "fold")
    z, net = np.zeros(targets.shape, np.float64), None
    for r in folds.mapInPandas(fold, "i bigint, net binary, " + ", ".join(f"{c} double" for c in CATEGORIES)).collect():
        if r[0] < 0:
            net = TextCnn()
            net.p = pickle.loads(r[1])
        else:
            z[r[0]] = r[2:]
    y.unpersist()
    return z, net


def main_language(trees: language.ContextTrees, segs: list) -> str:
    return trees.langs[max(segs, key=lambda s: s[1] - s[0])[2]] if segs else ""


def scored(docs: DataFrame, ratings: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, source, main_lang, score and flag of each category, for every document; whole texts are read.

    Null, empty and blank texts score 0 and have no flag. Ratings with a null in a category for all raters aren't used; a category
    without a positive rating scores 0 and is never flagged. Without a ``model`` one is trained.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model or train(spark, docs, ratings))

    def run(batches):
        m = shared.value
        reader = Reader()
        for pdf in batches:
            texts = [x if isinstance(x, str) and x.strip() else None for x in pdf["text"]]
            z, worded = m.net.text_logits(reader, texts)
            langs = [main_language(m.trees, s) for s in language.segments(m.trees, texts)]
            cut = np.array([m.limits.get(x, m.limits[""]) for x in langs]).reshape(-1, len(CATEGORIES))
            p = np.where(worded[:, None], _sigmoid(z - cut), 0.0)
            p[~np.isfinite(cut)] = 0.0
            out = pd.DataFrame({"doc_id": pdf["doc_id"], "source": pdf["source"], "main_lang": langs})
            for n, c in enumerate(CATEGORIES):
                out[f"{c}_score"], out[c] = p[:, n], worded & (z[:, n] >= cut[:, n])
            yield out

    columns = ", ".join(f"{c}_score double, {c} boolean" for c in CATEGORIES)
    return docs.select("doc_id", "source", "text").mapInPandas(run, f"doc_id bigint, source string, main_lang string, {columns}")


def found(docs: DataFrame, ratings: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, category: one row for each category flagged in a document; the flags of ``scored``.

    Without a ``model`` one is trained, always anew, so that a run's figures hold the training; scores and rates of the same
    session take it over. Where a document lies below the thresholds of all languages, or above, its own language isn't asked.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model or train(spark, docs, ratings, reuse=False))

    def run(batches):
        m = shared.value
        reader = Reader()
        for pdf in batches:
            texts = [x if isinstance(x, str) and x.strip() else None for x in pdf["text"]]
            z, worded = m.net.text_logits(reader, texts)
            open_ = np.flatnonzero(worded & ((z >= m.least) & (z < m.most)).any(axis=1))
            cut = np.repeat(m.most[None], len(texts), axis=0)
            segs = language.segments(m.trees, [texts[i] for i in open_])
            for i, s in zip(open_, segs):
                cut[i] = m.limits.get(main_language(m.trees, s), m.limits[""])
            doc, of = np.nonzero(worded[:, None] & (z >= cut))
            if len(doc):
                yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy()[doc], "category": [CATEGORIES[c] for c in of]})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id bigint, category string")


def source_rates(docs: DataFrame, ratings: DataFrame) -> DataFrame:
    """source, documents and the share of documents flagged, by category; null sources are one group."""
    return scored(docs, ratings).groupBy("source").agg(F.count("*").alias("documents"), *[F.avg(F.col(c).cast("double")).alias(f"{c}_rate") for c in CATEGORIES])

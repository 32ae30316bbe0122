"""Language of documents and of their segments by prediction by partial matching.

One variable-order byte context tree per language, built from a bounded sample and then frozen. A byte costs
-log2(count / (total + distinct)) in the longest context that has seen it and -log2(distinct / (total + distinct)) for every
escape on the way there; unseen contexts cost nothing, the end of the ladder is the uniform byte. Code lengths of all
languages are looked up together in numpy. Sentences are coded, and a least-cost path with a price for every change of language
gives the segments.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LANGS = ("en", "de", "fr", "es", "it", "pt", "nl", "sv", "ko", "ja")
ORDER = 4
#: Bounds of the sample the trees are built from: documents per label, characters from which a document is none of them, and bytes
#: per language.
TRAIN_DOCS, TRAIN_CHARS, TRAIN_BYTES = 600, 5_000, 150_000
#: Bits that a change of language costs between two sentences, and letters that make a sentence (CJK letters count thrice).
SWITCH_BITS, SENTENCE_LETTERS = 24.0, 9

_CUT = regex.compile(r"(?:[.!?…]+[\"'»”’)\]]*(?=\s)|[。！？]+[」』）]*|\n)\s*")
_DROP = regex.compile(r"&(?:lt|gt|amp|quot|nbsp|#\d+);|</?[a-z][^<>]{0,80}>|(?<=&lt;)/?(?:br|p|b|i|em|strong|div|span)/?(?=&gt;)|https?://\S+|www\.\S+|\S+@\S+\.\S+|[#@]\w+|(?<![\p{Latin}\p{N}._:/#-])[\p{Latin}\p{N}._:/#-]*\p{N}[\p{Latin}\p{N}]*|\p{N}[\p{Latin}\p{N}]*|[​-‏﻿­\p{Cc}\p{So}\p{Sk}\p{Co}]+")
#: Whether there is anything to drop at all: most sentences have nothing, and to know that is far cheaper.
_MAYBE_ASCII = re.compile(r"[&<@#0-9\x00-\x1f\x7f^`]|http|www\.")
_MAYBE = regex.compile(r"[&<@#\p{N}​-‏﻿­\p{Cc}\p{So}\p{Sk}\p{Co}]|http|www\.")
_SPACE = regex.compile(r"\s+")
_CJK = regex.compile(r"[\p{Hangul}\p{Han}\p{Hiragana}\p{Katakana}]")
_LETTER = regex.compile(r"\p{L}")


def base_code(label: str | None) -> str | None:
    """The part of a label before - or _, in lower case, if it is a language known here."""
    code = (label or "").strip().replace("_", "-").split("-")[0].lower()
    return code if code in LANGS else None


def sentences(text: str) -> list[tuple[int, int]]:
    """Spans of the sentences of a text; they cover all but the white space between them."""
    out, start = [], 0
    for m in _CUT.finditer(text):
        if text[start : m.end()].strip():
            out.append((start, m.end()))
        start = m.end()
    if text[start:].strip():
        out.append((start, len(text)))
    return out


def plain(sentence: str) -> str:
    """What of a sentence is coded: lower case, no links, numbers, symbols or invisible characters, single blanks."""
    low = sentence.lower()
    if (_MAYBE_ASCII if low.isascii() else _MAYBE).search(low):
        low = _DROP.sub(" ", low)
    return " " + " ".join(low.split()) + " "


def weight(coded: str) -> int:
    """Letters, of which a Chinese, Japanese or Korean one counts thrice."""
    return len(_LETTER.findall(coded)) + 2 * len(_CJK.findall(coded))


class ContextTrees:
    """Frozen trees of all languages; ``cost`` gives code lengths in bits."""

    def __init__(self, samples: dict[str, list[str]], langs: tuple[str, ...] = LANGS, order: int = ORDER):
        self.langs, self.order = langs, order
        data = [self._bytes(samples.get(x, []))[0] for x in langs]
        self.keys, self.resolved, self.contexts, self.escape = [], [], [], []
        n_langs = len(langs)
        for k in range(order + 1):
            per = [np.unique(self._grams(d, k), return_counts=True) if len(d) else (np.empty(0, np.uint64), np.empty(0, np.int64)) for d in data]
            keys = np.unique(np.concatenate([p[0] for p in per])) if per else np.empty(0, np.uint64)
            count = np.zeros((len(keys), n_langs), np.float64)
            for i, (u, c) in enumerate(per):
                count[np.searchsorted(keys, u), i] = c
            ctx, start = np.unique(keys >> np.uint64(8), return_index=True)
            if len(keys):
                total, distinct = np.add.reduceat(count, start), np.add.reduceat((count > 0).astype(np.float64), start)
            else:
                total = distinct = np.zeros((0, n_langs))
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(distinct / (total + distinct)), 0.0)
                of = np.searchsorted(ctx, keys >> np.uint64(8))
                own = -np.log2(count / (total[of] + distinct[of]))
            lower = 8.0 if k == 0 else self.resolved[k - 1][np.searchsorted(self.keys[k - 1], keys & np.uint64((1 << (8 * k)) - 1))]
            self.keys.append(keys)
            self.resolved.append(np.where(count > 0, own, escape[of] + lower).astype(np.float32))
            self.contexts.append(ctx)
            self.escape.append(escape.astype(np.float32))

    def _bytes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All texts with ``order`` blanks before each, and where each begins."""
        raw = [b" " * self.order + t.encode("utf-8", "surrogatepass") for t in texts]
        lens = np.fromiter(map(len, raw), np.int64, len(raw))
        return np.frombuffer(b"".join(raw), np.uint8), np.cumsum(lens) - lens

    def _grams(self, d: np.ndarray, k: int) -> np.ndarray:
        """Key of the k + 1 bytes that end at each position from ``order`` on."""
        n = len(d) - self.order
        key = np.zeros(n, np.uint64)
        for j in range(k, -1, -1):
            key = key << np.uint64(8) | d[self.order - j : self.order - j + n]
        return key

    def cost(self, texts: list[str]) -> np.ndarray:
        """Bits of each text in each language."""
        if not texts:
            return np.zeros((0, len(self.langs)), np.float32)
        d, starts = self._bytes(texts)
        n = len(d) - self.order
        bits = np.zeros((n, len(self.langs)), np.float32)
        todo = np.arange(n)
        full = self._grams(d, self.order)
        for k in range(self.order, -1, -1):
            key = full[todo] & np.uint64((1 << (8 * (k + 1))) - 1)
            keys = self.keys[k]
            if not len(keys):
                continue
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[at] == key
            bits[todo[hit]] += self.resolved[k][at[hit]]
            todo, key = todo[~hit], key[~hit] >> np.uint64(8)
            if not len(todo):
                break
            at = np.minimum(np.searchsorted(self.contexts[k], key), len(self.contexts[k]) - 1)
            seen = self.contexts[k][at] == key
            bits[todo[seen]] += self.escape[k][at[seen]]
        bits[todo] += 8.0
        # the blanks before a text are context and cost nothing
        lens = np.diff(np.r_[starts, len(d)])
        cum = np.concatenate([np.zeros((1, bits.shape[1])), np.cumsum(bits, axis=0, dtype=np.float64)])
        return (cum[starts + lens - self.order] - cum[starts]).astype(np.float32)


def best_path(bits: np.ndarray, switch: float = SWITCH_BITS) -> list[int]:
    """The language of each sentence with the least code length, where each change costs ``switch`` bits."""
    first = bits.argmin(axis=1)
    if (first == first[0]).all():
        return first.tolist()
    total, back = bits[0].astype(np.float64), []
    for row in bits[1:]:
        j = int(total.argmin())
        stay = total <= total[j] + switch
        back.append(np.where(stay, np.arange(len(row)), j))
        total = np.where(stay, total, total[j] + switch) + row
    path = [int(total.argmin())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def segments(trees: ContextTrees, texts: list[str | None], chunk: int = 2_000_000) -> list[list[tuple[int, int, int, float, int]]]:
    """(start, end, language, confidence, letters) of the segments of each text; a text without a word has none.

    Confidence is the posterior of the language among all under equal priors, from the exact code lengths per sentence, the
    segment's sentences taken together with a weight of one over the root of their number.
    """
    out: list[list] = []
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size < chunk):
            size += len(texts[j] or "")
            j += 1
        spans = [sentences(t) if t else [] for t in texts[i:j]]
        seen: dict[str, str] = {}  # a sentence that occurs again is cleaned once
        coded = []
        for t, sp in zip(texts[i:j], spans):
            cs = []
            for a, b in sp:
                raw = t[a:b]
                c = seen.get(raw)
                if c is None:
                    c = seen[raw] = plain(raw)
                cs.append(c)
            coded.append(cs)
        place: dict[str, int] = {}
        for cs in coded:
            for c in cs:
                place.setdefault(c, len(place))
        unique = list(place)
        bits = trees.cost(unique)
        letters = [weight(c) for c in unique]
        for sp, cs in zip(spans, coded):
            keep = [(s, place[c]) for s, c in zip(sp, cs) if letters[place[c]]]
            if not keep:
                out.append([])
                continue
            rows = bits[[p for _, p in keep]]
            path = best_path(rows)
            segs: list = []
            a = 0
            for b in range(1, len(path) + 1):
                if b == len(path) or path[b] != path[a]:
                    lang = path[a]
                    total = rows[a:b].sum(axis=0, dtype=np.float64) / np.sqrt(b - a)
                    gap = np.minimum(total - total[lang], 500)
                    most = max(letters[p] for _, p in keep[a:b])
                    segs.append((keep[a][0][0], keep[b - 1][0][1], lang, float(1 / np.sum(2.0**-gap)), sum(letters[p] for _, p in keep[a:b]), most))
                    a = b
            out.append(segs)
        i = j
    return out


def labelled_sample(docs: DataFrame, per_label: int = TRAIN_DOCS) -> DataFrame:
    """At most ``per_label`` distinct texts of each known language by label, those of least hash.

    Copies count once. Texts of 20 characters or less, or of TRAIN_CHARS or more, are no examples. Where a label has more than
    eight times as many texts, a second hash first keeps about four times as many of them, so that no label makes a large task.
    """
    code = F.lower(F.regexp_extract("lang", r"^\s*([A-Za-z]+)", 1))
    some = docs.select(code.alias("code"), "text").filter(F.col("code").isin(*LANGS) & (F.length(F.trim("text")) > 20) & (F.length("text") < TRAIN_CHARS))
    keyed = some.withColumn("h", F.xxhash64("text"))
    # where a label has very many texts, the hash alone rules most of them out before any is moved
    many = keyed.groupBy("code").agg(F.approx_count_distinct("h").alias("n"))
    bound = many.select("code", F.when(F.col("n") > 8 * per_label, F.lit(4.0 * per_label) / F.col("n")).otherwise(F.lit(1.0)).alias("share"))
    near = keyed.join(F.broadcast(bound), "code").filter(F.pmod(F.xxhash64("h"), F.lit(1 << 30)) < F.col("share") * (1 << 30)).select("code", "h", "text").distinct()
    return near.withColumn("rn", F.row_number().over(Window.partitionBy("code").orderBy("h", "text"))).filter(F.col("rn") <= per_label).select("code", "text")


def _joint_bits(known: dict[str, list[str]], texts: list[str]) -> np.ndarray:
    """-log2 of the share of each text's byte trigrams in all trigrams of a language.

    Unlike the context trees, where strange text costs only the way into its contexts, shares stay small for text that is
    a minority among the examples of a language; so wrong labels are outvoted.
    """
    grams = lambda t: np.frombuffer(b"  " + t.encode("utf-8", "surrogatepass"), np.uint8).astype(np.int64)
    key = lambda d: (d[:-2] << 16 | d[1:-1] << 8 | d[2:]) if len(d) > 2 else np.zeros(0, np.int64)
    own = [np.unique(np.concatenate([key(grams(t)) for t in known[x]] or [np.zeros(0, np.int64)]), return_counts=True) if x in known else (np.zeros(0, np.int64),) * 2 for x in LANGS]
    keys = np.unique(np.concatenate([u for u, _ in own]))
    table = np.full((len(LANGS), len(keys) + 1), 0.1, np.float32)
    for i, (u, c) in enumerate(own):
        table[i, np.searchsorted(keys, u)] += c
    table = np.log2(table)
    at = lambda k: np.where(keys[np.minimum(np.searchsorted(keys, k), len(keys) - 1)] == k, np.searchsorted(keys, k), len(keys))
    total = np.array([c.sum() + 0.1 * (len(keys) + 1) for _, c in own])
    return np.array([(np.log2(total)[:, None] - table[:, at(key(grams(t)))]).sum(axis=1) for t in texts]).reshape(-1, len(LANGS))


def examples(docs: DataFrame) -> list[tuple[str, str]]:
    """(label, text) of the labelled sample, in order."""
    return sorted((r[0], r[1]) for r in labelled_sample(docs).collect())


def grow(sample: list[tuple[str, str]]) -> ContextTrees:
    """Trees from labelled texts, whose labels may be wrong as long as most of each language's are right.

    Every sentence of the sample first goes, twice, to the language in whose examples its trigrams have the largest share;
    the trees grow from those sentences. With no labelled text the trees are empty and every text gets the first language at
    a confidence of one over the number of languages.
    """
    known: dict[str, list[str]] = {}
    for code, text in sample:
        s = (plain(text[a:b]) for a, b in sentences(text))
        known.setdefault(code, []).extend(x for x in s if weight(x) >= SENTENCE_LETTERS)
    whole = list(dict.fromkeys(x for v in known.values() for x in v))
    for _ in range(2):
        best = _joint_bits(known, whole).argmin(axis=1)
        known = {}
        for x, i in zip(whole, best):
            known.setdefault(LANGS[i], []).append(x)
    return ContextTrees({k: _bounded(v) for k, v in known.items()})


def train(docs: DataFrame) -> ContextTrees:
    """Trees from the labelled sample of ``docs``."""
    return grow(examples(docs))


def _bounded(texts: list[str]) -> list[str]:
    """Distinct texts up to the bound on bytes, taken evenly."""
    texts = list(dict.fromkeys(texts))
    total = sum(len(t.encode()) for t in texts)
    step = max(1.0, total / TRAIN_BYTES)
    return [texts[int(i * step)] for i in range(int(len(texts) / step))]


def document_segments(spark: SparkSession, docs: DataFrame, trees: ContextTrees) -> DataFrame:
    """doc_id, label, lang_no, segment_no, start_char, end_char, confidence, letters, most of all segments, whole texts."""
    shared = spark.sparkContext.broadcast(trees)

    def run(batches):
        model = shared.value
        for pdf in batches:
            rows = []
            for doc, label, segs in zip(pdf["doc_id"], pdf["lang"], segments(model, [x if isinstance(x, str) else None for x in pdf["text"]])):
                rows += [(doc, label, n, a, b, model.langs[lang], conf, letters, most) for n, (a, b, lang, conf, letters, most) in enumerate(segs)]
            yield pd.DataFrame(rows, columns=["doc_id", "label", "segment_no", "start_char", "end_char", "lang", "confidence", "letters", "most"])

    return docs.select("doc_id", "lang", "text").mapInPandas(run, "doc_id bigint, label string, segment_no int, start_char int, end_char int, lang string, confidence double, letters int, most int")


def language_segments(docs: DataFrame) -> DataFrame:
    """doc_id, segment_no, start_char, end_char, lang, confidence: the segments of every document that has a word."""
    return document_segments(docs.sparkSession, docs, train(docs)).select("doc_id", "segment_no", "start_char", "end_char", "lang", "confidence")


def relabelled(docs: DataFrame) -> DataFrame:
    """doc_id, lang: languages with whole sentences of documents whose label is missing, wrong or not the only language.

    A segment counts if one of its sentences has SENTENCE_LETTERS letters; where none of a document does, its largest counts.
    Documents with null, empty or blank text, or without a letter, have no row. One document is a row of ``docs``.
    """
    s = document_segments(docs.sparkSession, docs, train(docs))
    # all segments of a document come from one row, so a group is as small as a text
    by = s.groupBy("doc_id", "label", "lang").agg(F.sum("letters").alias("letters"), F.max("most").alias("most"), F.sum(F.col("end_char") - F.col("start_char")).alias("chars"))
    doc = Window.partitionBy("doc_id")
    by = by.withColumn("top", F.max("most").over(doc)).filter((F.col("most") >= SENTENCE_LETTERS) | (F.col("most") == F.col("top")))
    by = by.withColumns({"n": F.count("*").over(doc), "main": F.max(F.struct("chars", "lang")).over(doc)["lang"]})
    code = F.lower(F.regexp_extract("label", r"^\s*([^-_]*)", 1))
    return by.filter((F.col("n") > 1) | ~F.coalesce(code == F.col("main"), F.lit(False))).select("doc_id", "lang").distinct()

"""Byte-pair encoding of whole columns with a public vocabulary, by an index from pairs to all their positions.

A chunk of texts becomes one symbol array with doubly linked neighbours over its distinct pre-tokens. Every pair of
neighbours that has a rank is listed under it; ranks are taken off a heap in ascending order, all positions of a rank merge at
once in numpy, and the pairs that arise are listed under their own, always higher, ranks. One sweep is exact BPE.
"""

from __future__ import annotations

import heapq
import importlib.util
import json
import os
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark import SparkContext, SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pre-token pattern of the byte_bpe_50k vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Characters of text that one sweep takes in, and distinct pre-tokens that a worker remembers between sweeps.
CHUNK_CHARS, MEMORY_WORDS = 4_000_000, 300_000


def vocabulary_path(name: str = "byte_bpe_50k.json", folder: str | None = None) -> str:
    """Path of a public vocabulary file: in ``folder``, $TAMIS_TOKENIZERS, the public_tokenizers module or /opt/tokenizers."""
    folder = folder or os.environ.get("TAMIS_TOKENIZERS")
    if not folder:
        spec = importlib.util.find_spec("public_tokenizers")
        folder = os.path.dirname(spec.origin) if spec and spec.origin else "/opt/tokenizers"
    return os.path.join(folder, name)


def _byte_symbols() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for the 256 bytes."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class PairIndexEncoder:
    """Encodes texts with a byte-level merge list read from ``path``."""

    def __init__(self, path: str):
        model = json.load(open(path, encoding="utf-8"))["model"]
        vocab, merges = model["vocab"], model["merges"]
        self.byte_id = np.zeros(256, np.int32)
        for ch, b in _byte_symbols().items():
            self.byte_id[b] = vocab[ch]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left, right = (np.array([vocab[p[i]] for p in pairs], np.int64) for i in (0, 1))
        self.left, self.right = left.astype(np.int32), right.astype(np.int32)
        self.made = np.array([vocab[p[0] + p[1]] for p in pairs], np.int32)
        symbols = _byte_symbols()
        self.pieces = {i: bytes(symbols[c] for c in w) for w, i in vocab.items() if all(c in symbols for c in w)}
        keys = left << 32 | right
        self.order = np.argsort(keys, kind="stable").astype(np.int32)
        self.keys = keys[self.order]
        self.split = regex.compile(PATTERN)
        self.known: dict[str, np.ndarray] = {}

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, or -1."""
        k = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        return np.where(self.keys[at] == k, self.order[at], -1)

    def _list(self, ranks: np.ndarray, where: np.ndarray, index: dict, heap: list) -> None:
        """Enter positions under their ranks."""
        ok = ranks >= 0
        ranks, where = ranks[ok], where[ok]
        if not len(ranks):
            return
        if len(ranks) == 1:
            groups = [(int(ranks[0]), where)]
        else:
            o = np.argsort(ranks, kind="stable")
            ranks, where = ranks[o], where[o]
            cut = np.flatnonzero(np.diff(ranks)) + 1
            groups = zip(ranks[np.r_[0, cut]].tolist(), np.split(where, cut))
        for r, p in groups:
            if r in index:
                index[r].append(p)
            else:
                index[r] = [p]
                heapq.heappush(heap, r)

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each pre-token; none is empty."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        lens = np.fromiter(map(len, raw), np.int64, len(raw))
        sym = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        n = len(sym)
        ends = np.cumsum(lens)
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        nxt[ends - 1], prv[ends - lens] = -1, -1
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []
        at = np.flatnonzero(nxt >= 0)
        self._list(self._ranks(sym[at], sym[at + 1]), at, index, heap)
        while heap:
            r = heapq.heappop(heap)
            lists = index.pop(r)
            p = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            a, b = self.left[r], self.right[r]
            p = p[(sym[p] == a) & (nxt[p] >= 0)]
            p = p[sym[nxt[p]] == b]
            if not len(p):
                continue
            if a == b and len(p) > 1:  # in a run of equal symbols every second one, from the left
                p = np.sort(p)
                start = np.r_[True, nxt[p[:-1]] != p[1:]]
                first = np.maximum.accumulate(np.where(start, np.arange(len(p)), 0))
                p = p[(np.arange(len(p)) - first) % 2 == 0]
            gone = nxt[p]
            after = nxt[gone]
            sym[p], sym[gone] = self.made[r], -1
            nxt[p] = after
            has = after >= 0
            prv[after[has]] = p[has]
            before = prv[p]
            q = before[before >= 0]
            self._list(self._ranks(sym[q], sym[nxt[q]]), q, index, heap)
            q = p[has]
            self._list(self._ranks(sym[q], sym[nxt[q]]), q, index, heap)
        kept = np.flatnonzero(sym >= 0)
        cut = np.searchsorted(kept, ends[:-1])
        return np.split(sym[kept], cut)

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text; empty for None and ''."""
        out, i = [], 0
        while i < len(texts):
            j, size = i, 0
            while j < len(texts) and (j == i or size < CHUNK_CHARS):
                size += len(texts[j] or "")
                j += 1
            words = [self.split.findall(t) if t else [] for t in texts[i:j]]
            if len(self.known) > MEMORY_WORDS:
                self.known.clear()
            new = list({w for ws in words for w in ws if w not in self.known})
            if new:
                self.known.update(zip(new, (x.tolist() for x in self.encode_words(new))))
            known = self.known
            for ws in words:
                ids: list[int] = []
                for w in ws:
                    ids += known[w]
                out.append(ids)
            i = j
        return out


    def decode(self, ids: list[int]) -> str:
        """The text of a list of ids; bytes that are no UTF-8 become replacement marks."""
        return b"".join(self.pieces[i] for i in ids).decode("utf-8", "replace")


def ship_vocabulary(path: str) -> str:
    """Send the vocabulary file along with the job, once, so that workers need no copy of their own."""
    sc = SparkContext._active_spark_context
    sent = sc.__dict__.setdefault("_tamis_vocabularies", set()) if sc is not None else {path}
    if path not in sent:
        sc.addFile(path)
        sent.add(path)
    return path


@lru_cache(maxsize=2)
def encoder(path: str) -> PairIndexEncoder:
    """One per worker process and vocabulary: the file at ``path`` or, where there is none, the copy sent with the job."""
    return PairIndexEncoder(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)))


def token_ids(text: Column, path: str | None = None) -> Column:
    """array<int> of ids of a text column, without special tokens; their strings in a text are ordinary text.

    Null and empty texts have an empty list, blank texts are encoded.
    """
    path = ship_vocabulary(path or vocabulary_path())

    def ids(s: pd.Series) -> pd.Series:
        return pd.Series(encoder(path).encode([x if isinstance(x, str) else None for x in s]), index=s.index)

    return F.pandas_udf(ids, T.ArrayType(T.IntegerType()))(text)


def token_counts(text: Column, path: str | None = None) -> Column:
    """Number of ids of a text column; 0 for null and empty texts."""
    path = ship_vocabulary(path or vocabulary_path())

    def count(s: pd.Series) -> pd.Series:
        return pd.Series([len(x) for x in encoder(path).encode([x if isinstance(x, str) else None for x in s])], index=s.index, dtype="int64")

    return F.pandas_udf(count, T.LongType())(text)


def encode_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(key, ids) of every row. Only the two named columns are read; repeated rows stay repeated."""
    return docs.select(F.col(key), token_ids(F.col(text), path).alias("ids"))


def decoded_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(key, text): every text encoded and decoded again; null texts come back empty, all others as they were."""
    path = ship_vocabulary(path or vocabulary_path())

    def back(s: pd.Series) -> pd.Series:
        return pd.Series([encoder(path).decode(list(x)) for x in s], index=s.index, dtype=object)

    return encode_documents(docs, key, text, path).select(key, F.pandas_udf(back, T.StringType())("ids").alias("text"))

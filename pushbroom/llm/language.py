"""Language of each word by a linear-chain conditional random field, and of each document by its words.

A word's features are its prefixes and suffixes of one to three letters, its letter pairs
and triples with marks at both ends (hashed into one weight table), and its own entry in a lexicon of words that recur in training.
Transitions between the languages of neighbouring words are learned with the feature weights on sequences
that switch languages: training segments of known language, strung together. Forward-backward gives each word's
posterior in its whole document; a document's language is the one with the largest sum of posteriors, and its score the share of that sum.

The fit uses a bounded sample of training segments, ``SEGMENTS`` of each language, drawn by hash from whole texts.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .quality import fold
from .store import bound_arrow, kept

#: Training segments of each language used at most, and the words in a segment.
SEGMENTS, SEGMENT_WORDS = 1500, 30
#: Documents beyond one and a half times those drawn of a language among which they are drawn.
SPARE = 200
#: Rows of the hashed weight table, entries of the lexicon at most, and how often a lexicon word occurs at least.
TABLE, LEXICON, RECURS = 1 << 15, 20_000, 3
UNKNOWN = "und"
_A = np.uint32(2654435761)


def letters(token: str) -> str:
    """A token without what is no letter at its ends; empty if it has none."""
    a, b = 0, len(token)
    while a < b and not token[a].isalpha():
        a += 1
    while b > a and not token[b - 1].isalpha():
        b -= 1
    return token[a:b]


def _hash(tag: int, cols: list[np.ndarray]) -> np.ndarray:
    h = np.full(cols[0].shape, np.uint32(tag * 7919 + 1))
    for c in cols:
        h = (h ^ c) * _A
        h ^= h >> np.uint32(15)
    return h


class Features:
    """Feature numbers of words: an array of one row a word, padded with 0, the row of zero weight."""

    def __init__(self, lexicon: list[str]):
        self.lexicon = {w: 1 + TABLE + n for n, w in enumerate(lexicon)}
        self.size = 1 + TABLE + len(lexicon)

    def __call__(self, ws: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(word numbers, features) for groups of words of similar length."""
        sizes = np.fromiter(map(len, ws), dtype=np.int64, count=len(ws))
        bits = np.frompyfunc(lambda n: max(3, int(n - 1).bit_length()), 1, 1)(sizes).astype(int) if len(ws) else sizes
        out = []
        for k in np.unique(bits):
            at = np.flatnonzero(bits == k)
            for part in np.array_split(at, max(1, (len(at) << int(k)) >> 19)):
                out.append((part, self._group([ws[i] for i in part], sizes[part])))
        return out

    def _group(self, ws: list[str], sizes: np.ndarray) -> np.ndarray:
        width = int(sizes.max())
        c = np.zeros((len(ws), width + 2), np.uint32)
        c[:, 1:-1] = np.array(ws, dtype=f"U{width}").view(np.uint32).reshape(len(ws), width)
        pos = np.arange(width + 2)
        # pairs and triples span the marks at position 0 and after the last letter
        pairs = np.where(pos[:-1] <= sizes[:, None], _hash(1, [c[:, :-1], c[:, 1:]]) % TABLE + 1, 0)
        triples = np.where(pos[:-2] < sizes[:, None], _hash(2, [c[:, :-2], c[:, 1:-1], c[:, 2:]]) % TABLE + 1, 0)
        rows, cols = np.arange(len(ws)), [pairs, triples]
        for k in (1, 2, 3):
            pre = [c[:, min(j + 1, width + 1)] for j in range(k)]
            suf = [c[rows, np.maximum(sizes - j, 0)] for j in range(k)]
            for tag, x in ((2 + k, pre), (5 + k, suf)):
                cols.append(np.where(sizes >= k, _hash(tag, x) % TABLE + 1, 0)[:, None])
        cols.append(np.fromiter((self.lexicon.get(w, 0) for w in ws), dtype=np.int64, count=len(ws))[:, None])
        return np.concatenate(cols, axis=1).astype(np.int32)


def forward_backward(e: np.ndarray, live: np.ndarray, start: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Posteriors (time, row, label) for scores ``e`` (time, row, label).

    ``live`` (time, row) marks real words; each row's words stand first. ``trans`` [a, b] scores b after a.
    """
    steps = len(e)
    p = np.exp(e - e.max(axis=2, keepdims=True))
    m = np.exp(trans - trans.max())
    alpha, beta = np.empty_like(p), np.empty_like(p)
    a = np.exp(start - start.max()) * p[0]
    alpha[0] = a / a.sum(1, keepdims=True)
    for t in range(1, steps):
        a = (alpha[t - 1] @ m) * p[t]
        alpha[t] = a / a.sum(1, keepdims=True)
    beta[-1] = 1.0
    for t in range(steps - 2, -1, -1):
        follow = p[t + 1] * beta[t + 1]
        b = follow @ m.T
        b /= b.sum(1, keepdims=True)
        beta[t] = np.where(live[t + 1][:, None], b, 1.0)
    post = alpha * beta
    post /= post.sum(2, keepdims=True)
    return post * live[:, :, None]


def pair_counts(e: np.ndarray, post: np.ndarray, live: np.ndarray, start: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Expected counts of neighbouring labels, by a second sweep that keeps only sums."""
    steps = len(e)
    p, m = np.exp(e - e.max(axis=2, keepdims=True)), np.exp(trans - trans.max())
    a = np.exp(start - start.max()) * p[0]
    a /= a.sum(1, keepdims=True)
    out = np.zeros_like(trans)
    for t in range(1, steps):
        ahead = a @ m
        # P(label a, label b) = alpha(a) m(a,b) post(b) / ahead(b), as post holds all evidence from t on
        ratio = post[t] / np.maximum(ahead, 1e-300)
        out += m * (a.T @ (ratio * live[t][:, None]))
        a = ahead * p[t]
        a /= a.sum(1, keepdims=True)
    return out


class Model(NamedTuple):
    langs: list[str]
    lexicon: list[str]
    weights: np.ndarray
    start: np.ndarray
    trans: np.ndarray


def train(segments: list[tuple[str, str]], seed: int = 0, epochs: int = 4, batch: int = 50, rate: float = 0.3) -> Model:
    """Fits the field to (lang, text) segments strung into switching sequences, by Adagrad on the likelihood."""
    rng = np.random.default_rng(seed)
    langs = sorted({g for g, _ in segments})
    parts = [(langs.index(g), ws) for g, t in sorted(segments) if (ws := [w for w in map(letters, t.lower().split()) if w])]
    counts = Counter(w for _, ws in parts for w in ws)
    lexicon = sorted(w for w, n in counts.most_common(LEXICON) if n >= RECURS)
    find = Features(lexicon)
    vocab = sorted(counts)
    number = {w: n for n, w in enumerate(vocab)}
    groups = find(vocab)
    width = max((f.shape[1] for _, f in groups), default=1)
    feats = np.zeros((len(vocab), width), np.int32)
    for at, f in groups:
        feats[at, : f.shape[1]] = f
    n = len(langs)
    w, start, trans = np.zeros((find.size, n)), np.zeros(n), np.zeros((n, n))
    gw, gs, gt = np.full(w.shape, 1e-2), np.full(n, 1e-2), np.full((n, n), 1e-2)
    for _ in range(epochs if n > 1 else 0):
        order = rng.permutation(len(parts))
        seqs = [order[k : k + int(rng.integers(1, 5))] for k in range(0, len(order), 3)]
        for k in range(0, len(seqs), batch):
            rows = []
            for s in seqs[k : k + batch]:
                tokens, labels = [], []
                for i in s:
                    g, ws = parts[i]
                    cut = int(rng.integers(max(1, len(ws) // 4), len(ws) + 1))
                    tokens += [number[x] for x in ws[:cut]]
                    labels += [g] * cut
                rows.append((tokens, labels))
            steps = max(len(t) for t, _ in rows)
            tok, lab, live = np.zeros((steps, len(rows)), np.int64), np.zeros((steps, len(rows)), np.int64), np.zeros((steps, len(rows)), bool)
            for r, (t, y) in enumerate(rows):
                tok[: len(t), r], lab[: len(t), r], live[: len(t), r] = t, y, True
            f = feats[tok]
            e = w[f].sum(2)
            post = forward_backward(e, live, start, trans)
            pairs = pair_counts(e, post, live, start, trans)
            gold = np.eye(n)[lab] * live[:, :, None]
            diff = post - gold
            flat, d = f[live], diff[live]
            grad = np.column_stack([np.bincount(flat.ravel(), np.repeat(d[:, j], flat.shape[1]), minlength=find.size) for j in range(n)]) / len(rows)
            grad[0] = 0
            gw += grad**2
            w -= rate * grad / np.sqrt(gw) + 1e-6 * w
            g0 = diff[0].sum(0) / len(rows)
            seen = np.einsum("tra,trb->ab", gold[:-1] * live[1:, :, None], gold[1:])
            g1 = (pairs - seen) / len(rows)
            gs += g0**2
            gt += g1**2
            start -= rate * g0 / np.sqrt(gs)
            trans -= rate * g1 / np.sqrt(gt)
    return Model(langs, lexicon, w.astype(np.float32), start, trans)


class Labeller:
    """Sums of word posteriors of texts, remembering the scores of at most ``limit`` tokens."""

    def __init__(self, model: Model, limit: int = 300_000):
        self.model, self.limit, self.find = model, limit, Features(model.lexicon)
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.langs)), np.float32)
        self.used = 0

    def _learn(self, tokens: list[str]) -> None:
        words = [letters(t) for t in tokens]
        real = [n for n, w in enumerate(words) if w]
        for n, w in enumerate(words):
            if not w:
                self.known[tokens[n]] = -1
        need = self.used + len(real)
        if need > len(self.scores):
            grown = np.zeros((max(need, 2 * len(self.scores)), self.scores.shape[1]), np.float32)
            grown[: self.used] = self.scores[: self.used]
            self.scores = grown
        for at, f in self.find([words[n] for n in real]):
            self.scores[self.used + at] = self.model.weights[f].sum(1)
        for j, n in enumerate(real):
            self.known[tokens[n]] = self.used + j
        self.used = need

    def numbers(self, text: str | None) -> np.ndarray:
        tokens = (text or "").lower().split()
        if new := set(tokens).difference(self.known):
            self._learn(list(new))
        out = np.fromiter(map(self.known.__getitem__, tokens), dtype=np.int64, count=len(tokens))
        return out[out >= 0]

    def posteriors(self, texts: list[str | None]) -> Iterator[tuple[list[int], list[int], np.ndarray]]:
        """(places of texts, their words, posteriors by word, text and language) for groups of texts of similar length; texts without letters are in none."""
        if len(self.known) > self.limit:
            self.known, self.used = {}, 0
        seqs = [self.numbers(t) for t in texts]
        order = sorted((n for n, s in enumerate(seqs) if len(s)), key=lambda n: len(seqs[n]))
        k = 0
        while k < len(order):
            # rows of similar length, so that little is padded, and a bounded block of memory
            last = k + 1
            while last < len(order) and last - k < 512 and len(seqs[order[last]]) * (last - k + 1) <= 400_000 and len(seqs[order[last]]) <= 1.3 * len(seqs[order[k]]) + 8:
                last += 1
            rows = order[k:last]
            steps = len(seqs[rows[-1]])
            e, live = np.zeros((steps, len(rows), len(self.model.langs))), np.zeros((steps, len(rows)), bool)
            for r, n in enumerate(rows):
                e[: len(seqs[n]), r], live[: len(seqs[n]), r] = self.scores[seqs[n]], True
            yield rows, [len(seqs[n]) for n in rows], forward_backward(e, live, self.model.start, self.model.trans)
            k = last

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """(text, language) sums of posteriors, zeros for texts without letters."""
        out = np.zeros((len(texts), len(self.model.langs)))
        for rows, _, post in self.posteriors(texts):
            out[rows] = post.sum(0)
        return out


def _labeller(model: Model) -> Labeller:
    """The worker process's labeller of a model; its tasks share what it remembers."""
    key = hashlib.sha1(model.weights.tobytes() + model.trans.tobytes() + "\n".join(model.lexicon).encode()).digest()
    return kept(("labeller", key), lambda: Labeller(model))


def fit(spark: SparkSession, docs: DataFrame, folds: int = 4, held_out: int = 2, segments: int = SEGMENTS) -> Model:
    """Learns from text and non-null lang of documents outside the held-out fold.

    Each language's segments are the first ``segments`` by a hash of document and place, so every part of a text can be drawn. Null ids teach nothing.
    """
    bound_arrow(spark)
    rows = docs.where((fold(F.col("doc_id"), folds) != held_out) & F.col("lang").isNotNull() & (F.length("text") > 0))
    # ids are drawn first, so only the drawn documents' segments reach the driver. Of each language those below a share of all hashes
    # come to be sorted, a few more than are drawn however many there are
    many = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not many:
        return train([])
    share = {g: min(1.0, (1.5 * segments + SPARE) / n) for g, n in many.items()}
    below = F.create_map(*(F.lit(v) for g, x in share.items() for v in (g, int(x * 2**64) - 2**63 if x < 1 else 2**63 - 1)))
    some = rows.select("doc_id", "lang").where(F.xxhash64("doc_id") <= F.element_at(below, F.col("lang")))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    drawn = some.withColumn("_nth", nth).where(F.col("_nth") <= segments).select("doc_id").distinct()
    # a document offers one segment, at a place drawn by its hash, so copies and long texts do not crowd out others
    words = F.split(F.trim("text"), r"\s+")
    at = F.pmod(F.xxhash64("doc_id", F.lit("place")), F.greatest(F.size(words) - SEGMENT_WORDS + 1, F.lit(1))).cast("int")
    known = rows.select("doc_id", "lang", "text").join(F.broadcast(drawn), "doc_id")  # at most ``segments`` ids a language
    got = known.select("lang", F.array_join(F.slice(words, at + 1, SEGMENT_WORDS), " ").alias("t"))
    got = [(r.lang, r.t) for r in got.collect()]
    return train(got)


def label(spark: SparkSession, docs: DataFrame, model: Model, column: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (replacing columns of those names).

    Texts that are null or have no letters get ``und`` and score 0, as do all texts if nothing could be learned. Of languages with equal sums the first by
    name is taken; rows that repeat are judged alike, an empty table gives an empty result, and texts of any length are labelled whole.
    """
    bound_arrow(spark)
    found = _predictor(model)(F.col(column).cast("string"))
    return docs.withColumn("_p", found).withColumns({"lang_pred": F.col("_p.lang_pred"), "score": F.col("_p.score")}).drop("_p")


def _predictor(model: Model):
    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        labeller = _labeller(model)
        for t in texts:
            sums = labeller(t.tolist()) if model.langs else np.zeros((len(t), 1))
            total = sums.sum(1)
            best = sums.argmax(1)
            share = np.where(total > 0, sums.max(1) / np.maximum(total, 1e-300), 0.0)
            yield pd.DataFrame({"lang_pred": [model.langs[b] if v > 0 else UNKNOWN for b, v in zip(best, total)], "score": np.clip(share, 0, 1)})

    return predict


def label_words(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n, word, lang, posterior) for each word with letters of ``docs`` (doc_id, text): its language in its text, and how sure that is.

    n is the word's place among the white-space separated words of its text, from 0; word is without what is no letter at its ends, lower-cased. Of languages that are
    equally likely the first by name is taken. Null and empty texts have no rows, rows that repeat give rows that repeat.
    """
    bound_arrow(spark)
    fields = {"doc_id": pa.int64(), "n": pa.int64(), "word": pa.string(), "lang": pa.string(), "posterior": pa.float64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = _labeller(model)
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for rows, sizes, post in labeller.posteriors(texts) if model.langs else ():
                for r, (i, size) in enumerate(zip(rows, sizes)):
                    words = [(n, w) for n, t in enumerate(texts[i].lower().split()) if (w := letters(t))]
                    best = post[:size, r].argmax(1)
                    cols = [[ids[i]] * size, [n for n, _ in words], [w for _, w in words], [model.langs[k] for k in best], post[np.arange(size), r, best]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, fields.values())], list(fields))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n long, word string, lang string, posterior double")


def identify(spark: SparkSession, docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """``docs`` (doc_id, text, lang) with held_out, lang_pred and score, learned outside the held-out fold; lang is not read when predicting."""
    out = F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False))
    return label(spark, docs, fit(spark, docs, folds, held_out)).withColumn("held_out", out)

"""Benchmark decontamination: short test items found inside long documents by MinHash containment search.

An item is contained in a document if at least ``threshold`` of its distinct word
shingles occur there. MinHash estimates of Jaccard similarity fail here: a test item inside a long document
is a thousandth of it. So both sides are partitioned by size and sketched by one-permutation MinHash whose number of bins follows the
document's size class: hashes are cut into about ``size / load`` equal bins, and the least hash of each bin is kept. An item's shingle
that the document has is the least of its bin with probability (1 - exp(-load)) / load, independently
bin by bin; the load of an item's size class is chosen so that all of its shingles that must be there go
unseen with probability at most ``MISS``. Size classes of items with very few shingles get a load of 0: every shingle is its own minimum.

A document that shares a minimum with an item is a candidate, and is then held against the item's
own shingles, word for word. Documents never meet each other, so nothing is shuffled.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shingles import rolling, shingle_hashes, word_hashes, words
from .store import bound_arrow

WORDS, THRESHOLD, MISS = 5, 0.8, 1e-9
#: Items whose shingles one pass over the documents holds in memory; more items take more passes.
BLOCK_ITEMS = 20_000


def load_of(least: int) -> float:
    """The largest load at which ``least`` shingles all go unseen with probability at most MISS; 0 where none is."""
    miss = MISS ** (1 / max(1, least))
    low, high = 0.0, 8.0
    for _ in range(40):
        mid = (low + high) / 2
        low, high = (mid, high) if 1 - (1 - math.exp(-mid)) / mid <= miss else (low, mid)
    return low if low > 0.02 else 0.0


def n_bins(size: int, load: float) -> int:
    """Bins for a document of ``size`` shingles: its size class, rounded up to a power of two, over the load."""
    return 0 if load == 0 or size == 0 else max(1, math.ceil((1 << (size - 1).bit_length()) / load))


def minima(hashes: np.ndarray, bins: int) -> np.ndarray:
    """The least hash of each bin that has one, of sorted distinct ``hashes``; all of them for 0 bins."""
    if not bins or not len(hashes):
        return hashes
    which = ((hashes >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    return hashes[np.concatenate(([True], which[1:] != which[:-1]))]


class Items:
    """A block of test items, partitioned by shingle length and size class."""

    def __init__(self, items: list[tuple[int, str | None]], k: int, threshold: float):
        self.k, self.threshold, self.hash = k, threshold, word_hashes()
        self.words = {n: words(t) for n, (_, t) in enumerate(items)}
        self.ids = [i for i, _ in items]
        self.classes: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = defaultdict(list)
        self.sets: dict[int, set] = {}
        self.hashes: dict[int, np.ndarray] = {}
        for n, ws in self.words.items():
            if ws:
                h = shingle_hashes(self.hash(ws), k)
                # items of fewer than k words are one shingle of their own length
                self.classes[min(k, len(ws)), len(h).bit_length()].append((n, h))
                self.hashes[n] = h
        self.loads = {c: load_of(math.ceil(threshold * (1 << c[1] - 1))) for c in self.classes}
        self.tables: dict[tuple, tuple] = {}

    def table(self, c: tuple[int, int], bins: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted minima of the class's items under so many bins, and the item of each."""
        if (c, bins) not in self.tables:
            found = [(minima(h, bins), n) for n, h in self.classes[c]]
            keys = np.concatenate([m for m, _ in found])
            owner = np.concatenate([np.full(len(m), n) for m, n in found])
            order = np.argsort(keys, kind="stable")
            self.tables[c, bins] = keys[order], owner[order]
        return self.tables[c, bins]

    def shingles(self, n: int, k: int) -> set:
        if n not in self.sets:
            ws = self.words[n]
            self.sets[n] = {b" ".join(ws[j : j + k]) for j in range(len(ws) - k + 1)}
        return self.sets[n]

    def found_in(self, text: str | None) -> list[tuple[int, float]]:
        """(item number, containment) of the items that a text contains."""
        ws = words(text)
        h, tried = self.hash(ws), set()
        in_order = {k: rolling(h, k) for k in {c[0] for c in self.classes}}
        by_length = {k: np.unique(x) for k, x in in_order.items()}
        for c in self.classes:
            bins = n_bins(len(by_length[c[0]]), self.loads[c])
            keys, owner = self.table(c, bins)
            mins = minima(by_length[c[0]], bins)
            at = np.minimum(np.searchsorted(keys, mins), len(keys) - 1)
            for key in mins[keys[at] == mins]:
                tried.update((c[0], int(n)) for n in owner[np.searchsorted(keys, key) : np.searchsorted(keys, key, "right")])
        out = []
        for k, n in sorted(tried):
            want = self.shingles(n, k)
            # only words at the item's own hashes are compared
            held = len(want & {b" ".join(ws[j : j + k]) for j in np.flatnonzero(np.isin(in_order[k], self.hashes[n])).tolist()})
            if held >= self.threshold * len(want) - 1e-9:
                out.append((n, held / len(want)))
        return out


def contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = WORDS, threshold: float = THRESHOLD, block: int = BLOCK_ITEMS) -> DataFrame:
    """(doc_id, item_id, n_shingles, containment) for each document and each item that it contains.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are ignored. Items and documents without words
    (null, empty, white space) match nothing; a null id stays null in the pair. An item of fewer than ``k`` words is one shingle of all its words.
    Rows that repeat give pairs that repeat, items that tie are all reported, and empty tables give an empty result. A text of any length is searched whole; its
    shingles are held as eight bytes each. Items are the stated query set: they are taken in blocks of ``block`` by
    item_id order, and each block of bounded size goes to every document.
    """
    bound_arrow(spark)
    out = None
    for part in _blocks(items, block):
        found = _against(docs, part, k, threshold)
        out = found if out is None else out.unionByName(found)
    return out


def _blocks(items: DataFrame, block: int) -> Iterator[list[tuple[int, str | None]]]:
    """Blocks of (item_id, text); one empty block for no items."""
    items = items.select("item_id", F.col("text").cast("string").alias("text"))
    rows = items.count()
    for start in range(0, max(rows, 1), block):
        part = items if rows <= block else items.orderBy("item_id", "text").offset(start).limit(block)
        yield [tuple(r) for r in part.collect()]


def _against(docs: DataFrame, items: list[tuple[int, str | None]], k: int, threshold: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Items(items, k, threshold)
        sizes = {n: len(h) for members in index.classes.values() for n, h in members}
        for b in batches:
            rows = [(d, index.ids[n], sizes[n], c) for d, t in zip(b.column(0).to_pylist(), b.column(1)) for n, c in index.found_in(t.as_py())]
            cols = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.float64()))], ["doc_id", "item_id", "n_shingles", "containment"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, item_id long, n_shingles long, containment double")


def clean(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = WORDS, threshold: float = THRESHOLD, block: int = BLOCK_ITEMS) -> DataFrame:
    """The rows of ``docs`` whose text contains no item; all columns stay, and a row without a doc_id is judged like any other."""
    bound_arrow(spark)
    for part in _blocks(items, block):
        docs = docs.where(~_holds(part, k, threshold)(F.col("text").cast("string")))
    return docs


def _holds(items: list[tuple[int, str | None]], k: int, threshold: float):
    @F.pandas_udf("boolean")
    def holds(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Items(items, k, threshold)
        for t in texts:
            yield pd.Series([bool(index.found_in(x)) for x in t], dtype=bool)

    return holds

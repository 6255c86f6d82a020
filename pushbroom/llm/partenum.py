"""N-gram Jaccard join by PartEnum signatures.

Two sets with Jaccard similarity of at least p/100 and sizes a and b differ in at most (a + b)(100 - p)/(100 + p)
elements. Sizes are cut into bands; a set signs in its own band and in each higher one whose least sizes it can
reach. A band with at most k differences cuts the elements' domain into more than k/2 parts of three cells each:
two sets within k have a part with at most one differing cell, where two cells agree. The signatures of a set are, for
each part, its elements in each two of the three cells, so sets that are similar enough share one.

Signatures of few elements say little, so a set leaves out those below a level: the highest at which more of its parts than its own
differences could spoil have that many elements in every two cells. Of two similar sets, the one of the higher level has such a part unspoilt,
and the other signs there too. A set without such a level signs all it has, once more under another
partition, and after ``SEEDS`` of them with empty cells too. No pair is lost.

One pass over the texts makes sets' sizes, keys and bitmaps, and signatures packed by reducer. Sets with one key are one class from there on. A reducer
keeps the groups of classes that share a signature; nearly all signatures are their set's own and end there.

1. The members of each group are held against its least, first by bitmaps (bits that differ bound the elements
   that do), then exactly. Components of these links label the classes.
2. Groups whose members now have one label are done. In very large ones that stay open, members try other leaders for a few rounds.
3. In the groups still open, members of different labels are held against each other by bitmaps, in blocks where a group is
   large; members of the commonest label of a large group never meet each other. What bitmaps do not rule out is compared exactly,
   pair by pair where such pairs are few, and in blocks by the components that they form where they are many.

So the work follows the groups that stay open and not the square of a group of copies that link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import forest, grouped, link_rows, own_pairs
from .components import connected_components
from .shingles import mix, shingle_hashes, word_hashes, words
from .store import Workspace, bound_arrow, broadcast_within, partitions

SEEDS = 5
#: Bytes of signatures in a virtual reducer and in a task, about; signatures packed at once, at least and at most.
REDUCER_BYTES, TASK_BYTES, PACK, MOST_PACK = 4 << 20, 32 << 20, 500_000, 8_000_000
#: Signatures of a shingle, about, and the least that a reducer gets of a pack.
PER_SHINGLE, LEAST_SLICE = 0.8, 16
#: Classes of a pack that may share a signature; more send the least of them only.
LOCAL = 64
#: Members and shingles of a block of a large group, about.
BLOCK, BLOCK_SHINGLES = 400, 400_000
#: Rounds in which groups of over so many blocks try another leader, blocks whose bitmaps are held together, and pairs that a unit reports for each member at most.
ROUNDS, BLOCKS_TO_LEAD, OPEN_BLOCKS, DENSE = 5, 10, 5, 1
#: Classes up to which the rows that ask for their texts are broadcast (about 30 bytes each).
MANY_CLASSES = 200_000

_PACKED = "reducer int, doc_id long, n long, key long, bits binary, sigs binary, keys binary, hot binary, entries binary"
_MET = "target int, doc_id long, n long, key long, bits binary, entries binary"


class Bands:
    """Bands of set sizes for a threshold in percent, made as far as sizes need them."""

    def __init__(self, percent: int):
        self.percent, self.low, self.high, self._cuts = percent, [1], [1], {}

    def of(self, size: int) -> list[int]:
        """The bands in which a set of ``size`` signs."""
        while self.high[-1] < size or self._reaches(size, self.low[-1]):
            low = self.high[-1] + 1
            self.low.append(low)
            self.high.append(max(low, low * 10_000 // self.percent**2))
        return [n for n in range(len(self.low)) if self.low[n] <= size <= self.high[n] or self.low[n] > size and self._reaches(size, self.low[n])]

    def _reaches(self, small: int, large: int) -> bool:
        return 100 * small >= self.percent * large

    def differences(self, n: int, size: int | None = None) -> int:
        """Elements in which similar sets differ at most where the larger is in band ``n``; of a set of ``size`` and its partners there."""
        high = self.high[n]
        a, b = (high, high) if size is None else (size, min(high, 100 * size // self.percent))
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def cuts(self, n: int) -> np.ndarray:
        """Where the cells of band ``n`` begin in the domain, but for the first."""
        if n not in self._cuts:
            cells = 3 * parts_for(self.differences(n))
            self._cuts[n] = np.array([(i << 64) // cells for i in range(1, cells)], np.uint64)
        return self._cuts[n]


def parts_for(k: int) -> int:
    """Parts of a partition for ``k`` differences: more than k/2, with some to spare for parts with few elements."""
    need = k // 2 + 1
    return need if need == 1 else need + -(-need // 10)


def signatures(s: np.ndarray, bands: Bands) -> np.ndarray:
    """The signatures of a set of 64-bit hashes in ascending order."""
    out = []
    for band in bands.of(len(s)) if len(s) else ():
        if not bands.differences(band):
            out.append(mix(np.array([s.sum() + np.uint64(band)], np.uint64)))
            continue
        spoilt = bands.differences(band, len(s)) // 2
        for seed in range(SEEDS):
            x = np.sort(mix(s ^ mix(np.array([seed], np.uint64)))) if seed else s
            at = np.concatenate(([0], np.searchsorted(x, bands.cuts(band)), [len(x)]))
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(x))))
            sums, counts = np.diff(total[at]).reshape(-1, 3), np.diff(at).reshape(-1, 3)
            # by the cell left out
            counts = counts.sum(1, keepdims=True) - counts
            name = np.arange(sums.size, dtype=np.uint64) + np.uint64((seed * 4096 + band) << 32)
            sig = mix(sums.sum(1, keepdims=True) - sums + mix(name).reshape(-1, 3))
            level = int(np.sort(counts.min(1))[-1 - spoilt])
            out.append(sig[counts >= max(level, 1)] if level or seed < SEEDS - 1 else sig.ravel())
            if level:
                break
    return np.unique(np.concatenate(out)) if out else np.empty(0, np.uint64)


def set_key(s: np.ndarray) -> int:
    """A 64-bit key of a set: equal sets have equal keys."""
    return int(mix(np.array([mix(s).sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64)).view(np.int64)[0])


def bitmap(s: np.ndarray) -> bytes:
    """Which ranges of the domain have elements of ``s``: four to eight for each element."""
    b = max(6, (4 * len(s) - 1).bit_length())
    bits = np.zeros(1 << b, np.uint8)
    bits[(s >> np.uint64(64 - b)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    """A bitmap as one of ``size`` bytes: neighbours are joined."""
    while len(bits) > size:
        bits = np.packbits(np.unpackbits(bits).reshape(-1, 2).max(1))
    return bits


def _least_difference(x: bytes, y: bytes) -> int:
    """Elements in which the sets of two bitmaps differ at least."""
    if len(x) != len(y):
        size = min(len(x), len(y))
        x, y = (fold(np.frombuffer(b, np.uint8), size).tobytes() for b in (x, y))
    return (int.from_bytes(x) ^ int.from_bytes(y)).bit_count()


def _record(schema: str, rows: int, **columns) -> pa.RecordBatch:
    """A batch of ``rows`` rows; columns that are not given are null."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns[c], kinds[k]) if c in columns else pa.nulls(rows, kinds[k]) for c, k in fields], [c for c, _ in fields])


def _sorted(sig: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signatures and keys in order without repeats, where each signature's group begins, and its size."""
    order = np.lexsort((key, sig))
    s, d = sig[order], key[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (d[1:] != d[:-1])
    s, d = s[new], d[new]
    first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1]))) if len(s) else np.empty(0, np.int64)
    return s, d, first, np.diff(np.append(first, len(s)))


def _entries(gid: np.ndarray, d: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rows (gid, key, lead) of the members of groups but their first, which leads."""
    rest = size - 1
    start = np.repeat(first + 1 - np.concatenate(([0], np.cumsum(rest)[:-1])), rest) if len(first) else np.empty(0, np.int64)
    return np.column_stack([np.repeat(gid, rest), d[start + np.arange(len(start))], np.repeat(d[first], rest)])


def _groups(sig: np.ndarray, key: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Entries of the groups of classes that share a signature, one group of several with the same members.

    A group is named by its members, one with a hot signature (whose members packs hold back) by that.
    """
    s, d, first, size = _sorted(sig, key)
    of = s[first]
    gid = mix(np.add.reduceat(mix(d.view(np.uint64)), first) + size.astype(np.uint64)) if len(first) else of
    gid = np.where(np.isin(of, hot), of, gid).view(np.int64)
    at = np.flatnonzero(size > 1)
    at = at[np.unique(gid[at], return_index=True)[1]]
    return _entries(gid[at], d, first[at], size[at])


def _dealt(entries: np.ndarray, targets: int) -> pa.RecordBatch:
    """Entries as packed rows, dealt by group and key."""
    target = (mix(entries[:, 0].view(np.uint64) ^ mix(entries[:, 1].view(np.uint64))) % np.uint64(targets)).astype(np.int64)
    order = np.argsort(target, kind="stable")
    cut = np.searchsorted(target[order], np.arange(targets + 1))
    full = np.flatnonzero(cut[1:] > cut[:-1])
    rows = entries[order]
    return _record(_MET, len(full), target=full, entries=[rows[cut[t] : cut[t + 1]].tobytes() for t in full])


def _unpack(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.int64).reshape(-1, 3)


def _signed(text_bytes: int) -> int:
    """Bytes of signatures of so many bytes of text, about."""
    return int(text_bytes / 6 * PER_SHINGLE * 16)


def sets_and_groups(docs: DataFrame, k: int, percent: int, text_bytes: int, n_parts: int) -> DataFrame:
    """One pass over ``docs``: rows (doc_id, n, key, bits) of its rows' sets, and packed entries of the groups by target, of ``n_parts``."""
    signed = _signed(text_bytes)
    pack_size = min(MOST_PACK, max(PACK, signed // REDUCER_BYTES * LEAST_SLICE))
    reducers = min(pack_size // LEAST_SLICE, max(4 * n_parts, signed // REDUCER_BYTES))
    edges = np.array([(i << 64) // reducers for i in range(1, reducers)], np.uint64)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bands, seen = word_hashes(), Bands(percent), set()
        sigs, keys, held, nth = [], [], 0, 0

        def flush() -> pa.RecordBatch:
            s, d, first, size = _sorted(np.concatenate(sigs), np.concatenate(keys))
            sigs.clear()
            keys.clear()
            many = np.flatnonzero(size > LOCAL)
            hot = s[first[many]]
            local = _entries(hot.view(np.int64), d, first[many], size[many])
            if len(many):
                stay = np.repeat(size <= LOCAL, size)
                stay[first] = True
                s, d = s[stay], d[stay]
            reducer = lambda x: np.concatenate(([0], np.searchsorted(x, edges), [len(x)]))
            cut, cut_hot = reducer(s), reducer(hot)
            full = np.flatnonzero(cut[1:] > cut[:-1])
            # a column's rows by reducer, then the entries held back
            columns = {
                "reducer": [*full, nth % reducers],
                "sigs": [*(s[cut[r] : cut[r + 1]].tobytes() for r in full), None],
                "keys": [*(d[cut[r] : cut[r + 1]].tobytes() for r in full), None],
                "hot": [*(hot[cut_hot[r] : cut_hot[r + 1]].tobytes() for r in full), None],
                "entries": [*[None] * len(full), local.tobytes()],
            }
            return _record(_PACKED, len(full) + 1, **columns)

        for b in batches:
            size, key, bits = [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                s = shingle_hashes(known(words(t.as_py())), k)
                size.append(len(s))
                key.append(set_key(s))
                bits.append(bitmap(s) if len(s) and i is not None else None)
                # equal sets sign once
                if bits[-1] and key[-1] not in seen:
                    seen.add(key[-1])
                    sigs.append(signatures(s, bands))
                    keys.append(np.full(len(sigs[-1]), key[-1], np.int64))
                    held += len(sigs[-1])
                    if held >= pack_size:
                        yield flush()
                        held = 0
            if len(seen) > 200_000:
                seen.clear()
            rows = len(size)
            yield _record(_PACKED, rows, reducer=(nth + np.arange(rows)) % reducers, doc_id=b.column(0), n=size, key=key, bits=bits)
            nth += rows
        if sigs:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, found, held = None, [], [], 0

        def settle() -> None:
            if parts:
                found.append(_groups(*(np.frombuffer(b"".join(c), t) for c, t in zip(zip(*parts), (np.uint64, np.int64, np.uint64)))))
                parts.clear()

        for b in batches:
            c = {name: b.column(n) for n, name in enumerate(b.schema.names)}
            rows = c["n"].is_valid()
            if rows.true_count:
                kept = b.filter(rows)
                yield _record(_MET, kept.num_rows, **{name: kept.column(kept.schema.names.index(name)) for name in ("doc_id", "n", "key", "bits")})
            for n in np.flatnonzero(c["sigs"].is_valid().to_numpy(zero_copy_only=False)):
                r = c["reducer"][int(n)].as_py()
                if r != at:
                    settle()
                    at = r
                parts.append(tuple(c[x][int(n)].as_py() for x in ("sigs", "keys", "hot")))
            found += [_unpack([e.as_py()]) for e in c["entries"].drop_null()]
            if sum(map(len, found)) > 200_000:
                yield _dealt(np.concatenate(found), n_parts)
                found.clear()
        settle()
        if found:
            yield _dealt(np.concatenate(found), n_parts)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    packed = rows.mapInArrow(pack, _PACKED)
    return packed.repartition(n_parts, "reducer").sortWithinPartitions("reducer").mapInArrow(meet, _MET)


def entry_table(met: DataFrame, n_parts: int) -> DataFrame:
    """(gid, key, lead): the entries of ``sets_and_groups`` without repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [x for b in batches for x in b.column(1).to_pylist()]
        e = _unpack(blobs)
        e = e[np.lexsort(e.T[::-1])]
        e = e[np.concatenate(([True], (e[1:] != e[:-1]).any(1)))] if len(e) else e
        for n in range(0, len(e), 100_000):
            part = e[n : n + 100_000]
            yield _record("gid long, key long, lead long", len(part), gid=part[:, 0], key=part[:, 1], lead=part[:, 2])

    packed = met.where("entries IS NOT NULL").select("target", "entries")
    return packed.repartition(n_parts, "target").mapInArrow(run, "gid long, key long, lead long")


class _Join:
    """The tables of one join, and exact comparison of pairs of classes."""

    def __init__(self, spark: SparkSession, docs: DataFrame, k: int, percent: int):
        bound_arrow(spark)
        self.ws, self.docs, self.k, self.percent = Workspace(spark, "jaccard"), docs.select("doc_id", "text"), k, percent
        text_bytes = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
        n_parts = max(partitions(spark), _signed(text_bytes) // TASK_BYTES + 1)
        met = self.ws.table(sets_and_groups(self.docs, k, percent, text_bytes, n_parts), "sets")
        self.sets = met.where("n IS NOT NULL").select("doc_id", "n", "key", "bits")
        self.entries = self.ws.table(entry_table(met, n_parts), "entries")
        keys = self.entries.select(F.explode(F.array("key", "lead")).alias("key")).distinct()
        # copies of a class are combined before they are dealt
        least = self.linkable().groupBy("key").agg(F.min(F.struct("doc_id", "n", "bits")).alias("of")).join(keys, "key", "left_semi")
        #: a row for each class that shares a signature
        self.nodes = self.ws.table(least.select("key", F.col("of.doc_id").alias("rep"), F.col("of.n").alias("n"), F.col("of.bits").alias("bits")), "nodes")

    def linkable(self) -> DataFrame:
        return self.sets.where("n > 0 AND doc_id IS NOT NULL")

    def near(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` (a, b) that bitmaps do not rule out."""
        percent = self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                a, c, na, nc, xa, xc = (x.to_pylist() for x in b.columns)
                keep = [(100 + percent) * _least_difference(x, y) <= (100 - percent) * (m + n) for m, n, x, y in zip(na, nc, xa, xc)]
                yield pa.RecordBatch.from_arrays([pa.array([v for v, ok in zip(col, keep) if ok], pa.int64()) for col in (a, c)], ["a", "b"])

        of = lambda c: self.nodes.select(F.col("key").alias(c), F.col("n").alias(f"n{c}"), F.col("bits").alias(f"x{c}"))
        rows = pairs.join(of("a"), "a").join(of("b"), "b")
        return rows.select("a", "b", "na", "nb", "xa", "xb").mapInArrow(run, "a long, b long")

    def elements(self, keys: DataFrame) -> DataFrame:
        """(key, elements) of the classes ``keys`` (key), from their least documents' texts."""
        k, ws = self.k, self.ws
        wanted = ws.table(keys.join(self.nodes, "key").select("key", "rep"), "wanted")
        rows = self.docs.join(broadcast_within(wanted, wanted.count(), MANY_CLASSES), F.col("doc_id") == F.col("rep")).select("text", "key")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = word_hashes()
            for b in batches:
                sets = [shingle_hashes(known(words(t.as_py())), k) for t in b.column(0)]
                # of rows that share a doc_id only those with the class's own text
                own = [set_key(s) == key for s, key in zip(sets, b.column(1).to_pylist())]
                made = [(key, s.tobytes()) for s, key, ok in zip(sets, b.column(1).to_pylist(), own) if ok]
                yield _record("key long, elements binary", len(made), key=[m[0] for m in made], elements=[m[1] for m in made])

        made = rows.mapInArrow(run, "key long, elements binary")
        return ws.table(made.groupBy("key").agg(F.first("elements").alias("elements")), "elements")

    def linked(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` (a, b) that link, as a written table."""
        percent, near = self.percent, self.ws.table(self.near(pairs), "near")
        elements = self.elements(near.select(F.explode(F.array("a", "b")).alias("key")).distinct())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                a, c, x, y = (col.to_pylist() for col in b.columns)
                out = []
                for n, (p, q) in enumerate(zip(x, y)):
                    p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                    both = len(np.intersect1d(p, q, assume_unique=True))
                    if 100 * both >= percent * (len(p) + len(q) - both):
                        out.append((a[n], c[n]))
                yield _record("a long, b long", len(out), a=[p[0] for p in out], b=[p[1] for p in out])

        of = lambda c: elements.select(F.col("key").alias(c), F.col("elements").alias(f"x{c}"))
        rows = near.join(of("a"), "a").join(of("b"), "b").select("a", "b", "xa", "xb")
        return self.ws.table(rows.mapInArrow(run, "a long, b long"), "linked")

    def labels(self) -> DataFrame:
        """(node, component) of the classes that link with another, by key."""
        ws = self.ws
        tested = ws.table(self.entries.select(F.col("key").alias("a"), F.col("lead").alias("b")).distinct(), "tested")
        edges = self.linked(tested)
        labels = ws.table(connected_components(ws, edges), "labels")
        for nth in range(ROUNDS):
            members, sizes = self.open_groups(labels)
            large = sizes.where(F.col("members") > BLOCKS_TO_LEAD * BLOCK).select("gid")
            if not large.limit(1).count():
                break
            pairs = ws.table(_led(members.join(large, "gid"), nth).join(tested, ["a", "b"], "left_anti"), "tested")
            tested, more = tested.unionByName(pairs), self.linked(pairs)
            if not more.limit(1).count():
                break
            edges = edges.unionByName(more)
            labels = ws.table(connected_components(ws, edges), "labels")
        else:
            members, sizes = self.open_groups(labels)
        found = ws.table(self.near_across(members, sizes), "across")
        pairs = found.where("links IS NULL").select(F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b")).distinct()
        more = self.linked(pairs.join(tested, ["a", "b"], "left_anti")).unionByName(self.linked_within(found.where("links IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b"))))
        more = ws.table(more, "more")
        return ws.table(connected_components(ws, edges.unionByName(more)), "labels") if more.limit(1).count() else labels

    def open_groups(self, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The members (gid, key, label) of the groups that have several labels, and (gid, members, most, common): their number, and how many have the commonest label."""
        label = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"{c}_label"))
        e = self.entries.join(label("key"), "key", "left").join(label("lead"), "lead", "left")
        e = self.ws.table(e.withColumns({f"{c}_label": F.coalesce(f"{c}_label", c) for c in ("key", "lead")}), "labelled")
        e = e.join(e.where("key_label <> lead_label").select("gid").distinct(), "gid", "left_semi")
        member = lambda c: e.select("gid", F.col(c).alias("key"), F.col(f"{c}_label").alias("label"))
        m = self.ws.table(member("key").unionByName(member("lead")).distinct(), "open")
        of = m.groupBy("gid", "label").agg(F.count("*").alias("many")).groupBy("gid")
        of = of.agg(F.sum("many").alias("members"), F.max("many").alias("most"), F.max_by("label", F.struct("many", "label")).alias("common"))
        return m, self.ws.table(of, "sizes")

    def near_across(self, members: DataFrame, sizes: DataFrame) -> DataFrame:
        """(node, other, links): pairs of classes of one group but of different labels that bitmaps do not rule out.

        Where a unit has many of them, the edges of a forest that joins them stand for them, with links 1.
        """
        m = members.join(sizes, "gid").withColumn("units", _open_units())
        rows = m.select("gid", "key", "label", F.explode("units").alias("u")).select("key", "label", "u.right", F.xxhash64("gid", "u.i", "u.j").alias("unit"))
        rows = rows.join(self.nodes.select("key", "n", "bits"), "key")
        return grouped(rows, "unit", _open_pairs(self.percent), partitions(self.ws.spark))

    def linked_within(self, edges: DataFrame) -> DataFrame:
        """(a, b): edges that join all classes which link within a component of ``edges``."""
        ws = self.ws
        groups = connected_components(ws, edges)
        m = groups.join(self.nodes.select(F.col("key").alias("node"), "n"), "node").select(F.col("node").alias("key"), "n", F.lit(1).cast("long").alias("copies"), F.col("component").alias("group"))
        return self.compared(m).where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b"))

    def compared(self, m: DataFrame) -> DataFrame:
        """(node, other, links) of exact comparisons of all classes of a group, for ``m`` (key, n, copies, group)."""
        units = self.ws.table(_units(m, self.percent), "units")
        rows = units.join(self.elements(units.select("key")), "key")
        rows = rows.select("key", "copies", "elements", F.explode("units").alias("u")).select("key", "copies", "elements", "u.right", F.xxhash64("u.group", "u.band", "u.i", "u.band2", "u.j").alias("unit"))
        return self.ws.table(grouped(rows, "unit", _compare(self.percent), partitions(self.ws.spark)), "compared")


def _led(members: DataFrame, nth: int) -> DataFrame:
    """(a, b): each member of a group with another leader, drawn by ``nth``, if its label differs; one for each label that it meets."""
    drawn = F.xxhash64("key", F.lit(nth))
    lead = members.groupBy("gid").agg(F.min_by(F.struct("key", "label"), drawn).alias("lead"))
    met = members.join(lead, "gid").where("label <> lead.label")
    one = met.groupBy("key", "lead.label").agg(F.min_by("lead.key", F.xxhash64("lead.key", F.lit(nth))).alias("other"))
    return one.select(F.greatest("key", "other").alias("a"), F.least("key", "other").alias("b")).distinct()


def _open_units() -> Column:
    """The units in which a member of an open group takes part: the whole of a small group.

    In a large one, blocks of members outside the commonest label meet each other (i, j >= 0) and blocks of those inside (j < 0).
    """
    unit = lambda i, j, right: F.struct(i.alias("i"), j.alias("j"), right.alias("right"))
    zero = F.lit(0).cast("long")
    blocks = lambda n: F.ceil(n / (OPEN_BLOCKS * BLOCK))
    outer, inner = blocks(F.col("members") - F.col("most")), blocks(F.col("most"))
    out, into = F.pmod(F.xxhash64("key"), outer), F.pmod(F.xxhash64("key"), inner)
    own = F.transform(own_pairs(out, outer), lambda p: unit(p["i"], p["j"], p["right"]))
    inward = F.transform(F.sequence(zero, inner - 1), lambda j: unit(out, -1 - j, F.lit(False)))
    outward = F.transform(F.sequence(zero, outer - 1), lambda i: unit(i, -1 - into, F.lit(True)))
    large = F.when(F.col("label") == F.col("common"), outward).otherwise(F.concat(own, inward))
    return F.when(F.col("members") <= OPEN_BLOCKS * BLOCK, F.array(unit(zero, zero, F.lit(False)))).otherwise(large)


def _open_pairs(percent: int):
    def pairs(held: dict[str, list]) -> list[tuple]:
        size = min(map(len, held["bits"]))
        bits = np.stack([fold(np.frombuffer(b, np.uint8), size) for b in held["bits"]])
        keys, label, right, n = (np.array(held[c]) for c in ("key", "label", "right", "n"))
        across = right.any() and not right.all()
        near = np.zeros((len(keys), len(keys)), bool)
        for i in range(len(keys) - 1):
            others = np.flatnonzero((label[i + 1 :] != label[i]) & ((right[i + 1 :] != right[i]) | (not across))) + i + 1
            if len(others):
                differ = np.bitwise_count(bits[others] ^ bits[i]).sum(1, dtype=np.int64)
                near[i, others] = (100 + percent) * differ <= (100 - percent) * (n[others] + n[i])
        if near.sum() > DENSE * len(keys):
            return link_rows({}, [(int(keys[a]), int(keys[b]), 1) for a, b in forest(near | near.T)])
        return link_rows({}, [(int(keys[a]), int(keys[b])) for a, b in zip(*np.nonzero(near))])

    return pairs


def with_keys(rows: DataFrame, k: int) -> DataFrame:
    """Adds _key and _n, the key and size of the set of each row's text."""

    @F.pandas_udf("_key long, _n long")
    def keys(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = word_hashes()
        for t in texts:
            sets = [shingle_hashes(known(words(x)), k) for x in t]
            yield pd.DataFrame({"_key": [set_key(s) for s in sets], "_n": [len(s) for s in sets]}, dtype="int64")

    bound_arrow(rows.sparkSession)
    return rows.withColumn("_set", keys(F.col("text").cast("string"))).select(*rows.columns, "_set._key", "_set._n")


def text_classes(spark: SparkSession, docs: DataFrame, k: int = 5, percent: int = 80) -> tuple[DataFrame, _Join, DataFrame]:
    """(doc_id, n, key, label, component, copies) for each row of ``docs``, by its own text: component is the least doc_id of the texts that it links with, directly or not.

    label is one key of the component: rows that share a doc_id are apart here, so a doc_id may be the least of several components.
    component is null for rows without words or doc_id. Also returns the join and the labels of classes that link.
    """
    join = _Join(spark, docs, k, percent)
    ws, labels = join.ws, join.labels()
    classes = join.linkable().groupBy("key", "n").agg(F.min("doc_id").alias("rep"), F.countDistinct("doc_id").alias("copies"))
    classes = ws.table(classes, "classes")
    of = labels.join(join.nodes.select(F.col("key").alias("node"), "rep"), "node")
    least = ws.table(of.join(of.groupBy("component").agg(F.min("rep").alias("least")), "component").select(F.col("node").alias("key"), F.col("component").alias("label"), "least"), "least")
    rows = join.sets.select("doc_id", "n", "key").join(classes, ["key", "n"], "left").join(least, "key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "rep"))
    return ws.table(rows.select("doc_id", "n", "key", F.coalesce("label", "key").alias("label"), component.alias("component"), "copies"), "rows"), join, labels


def jaccard_classes(spark: SparkSession, docs: DataFrame, k: int = 5, percent: int = 80, links: bool = True) -> DataFrame:
    """(doc_id, n_shingles, n_links, component_id) for each row of ``docs`` (doc_id, text).

    Documents link when 100 * intersection >= percent * union of their sets of ``k``-word shingles. n_links counts the other
    documents linked directly (it takes exact comparisons within each component, and is null without ``links``); component_id is the least doc_id reachable.
    Texts without words have an empty set and no links; shorter texts are one shingle.
    Rows that share a doc_id are one document for components: whatever any of its texts links with is reachable. A null doc_id links with nothing and has a null component.
    Columns besides the two are ignored; an empty table gives an empty result. Texts of any length are read whole; a set is held in
    memory as eight bytes a shingle. Sets are known by 64-bit keys and sizes, shingles by 64-bit hashes.
    """
    rows, join, labels = text_classes(spark, docs, k, percent)
    ws = join.ws
    # documents with texts in several components join them; a text without words is one of its own
    rows = rows.withColumn("component", F.coalesce("component", "doc_id"))
    lows = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    bridges = rows.join(lows, "doc_id").where("component <> low").select(F.col("component").alias("a"), F.col("low").alias("b"))
    merged = connected_components(ws, bridges).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    out = rows.join(merged, "component", "left").withColumn("component_id", F.coalesce("whole", "component"))
    if links:
        counts = _link_counts(join, labels)
        by_doc = rows.where("copies IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "key", "copies").distinct().join(counts, "key", "left")
        by_doc = by_doc.groupBy("doc_id").agg(F.sum(F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
        out = out.join(by_doc, "doc_id", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)).cast("long"))
    else:
        out = out.withColumn("n_links", F.lit(None).cast("long"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "n_links", "component_id")


def _link_counts(join: _Join, labels: DataFrame) -> DataFrame:
    """(key, links): documents linked with each class, its own copies apart."""
    copies = join.linkable().groupBy("key").agg(F.countDistinct("doc_id").alias("copies"))
    members = labels.join(join.nodes.select(F.col("key").alias("node"), "n"), "node").join(copies.withColumnRenamed("key", "node"), "node")
    found = join.compared(members.select(F.col("node").alias("key"), "n", "copies", F.col("component").alias("group")))
    return join.ws.table(found.where("other IS NULL").groupBy(F.col("node").alias("key")).agg(F.sum("links").alias("links")), "links")


def _compare(percent: int):
    def links(held: dict[str, list]) -> list[tuple]:
        sets = [np.frombuffer(s, np.uint64) for s in held["elements"]]
        right, copies, ids = np.array(held["right"]), np.array(held["copies"]), held["key"]
        sizes = np.array([len(s) for s in sets])
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        _, which, counts = np.unique(flat, return_inverse=True, return_counts=True)
        shared = counts > 1
        number = np.cumsum(shared) - 1
        keep = shared[which]
        col, row = number[which[keep]], owner[keep]
        order = np.argsort(col, kind="stable")
        col, row = col[order], row[order]
        inter = np.zeros((len(sets), len(sets)), np.float32)
        for start in range(0, int(shared.sum()), 4096):
            a, b = np.searchsorted(col, (start, start + 4096))
            m = np.zeros((len(sets), 4096), np.float32)
            m[row[a:b], col[a:b] - start] = 1
            inter += m @ m.T
        both = sizes[:, None] + sizes[None, :]
        linked = (100 + percent) * inter.astype(np.int64) >= percent * both
        np.fill_diagonal(linked, False)
        # a unit of two blocks compares across them only
        if right.any() and not right.all():
            linked &= right[:, None] != right[None, :]
        n = linked @ copies
        return link_rows({ids[i]: int(n[i]) for i in np.flatnonzero(n)}, [(ids[a], ids[b]) for a, b in forest(linked)])

    return links


def _units(m: DataFrame, percent: int) -> DataFrame:
    """(key, n, copies, units): the units of work in which each class of ``m`` (key, n, copies, group) takes part.

    A group within a block's bounds is one unit. In a larger one, sizes are cut into bands a little wider than the threshold's ratio, and bands into
    blocks; blocks of a band meet each other and those of the band above, as sizes further apart cannot link.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(101.0 / percent)))
    sizes = m.groupBy("group").agg(F.count("*").alias("members"), F.sum("n").alias("elements"))
    small = (F.col("members") <= BLOCK) & (F.col("elements") <= BLOCK_SHINGLES)
    m = m.join(sizes, "group").withColumns({"small": small, "band": F.when(small, F.lit(0).cast("long")).otherwise(band)})
    blocks = m.where("NOT small").groupBy("group", "band").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    at = lambda name, shift: blocks.select("group", (F.col("band") + shift).alias("band"), F.col("blocks").alias(name))
    m = m.join(at("own", 0), ["group", "band"], "left").join(at("up", -1), ["group", "band"], "left").join(at("down", 1), ["group", "band"], "left")
    own = F.coalesce("own", F.lit(1).cast("long"))
    salt = F.pmod(F.xxhash64("key"), own)
    unit = lambda b, i, b2, j, right: F.struct(F.col("group").alias("group"), b.alias("band"), i.alias("i"), b2.alias("band2"), j.alias("j"), right.alias("right"))
    here = F.transform(own_pairs(salt, own), lambda p: unit(F.col("band"), p["i"], F.col("band"), p["j"], p["right"]))
    every = lambda c: F.when(F.col(c).isNotNull(), F.sequence(F.lit(0).cast("long"), F.col(c) - 1)).otherwise(F.array().cast("array<bigint>"))
    up = F.transform(every("up"), lambda j: unit(F.col("band"), salt, F.col("band") + 1, j, F.lit(False)))
    down = F.transform(every("down"), lambda i: unit(F.col("band") - 1, i, F.col("band"), salt, F.lit(True)))
    return m.select("key", "n", "copies", F.concat(here, up, down).alias("units"))

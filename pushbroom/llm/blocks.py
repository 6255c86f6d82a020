"""Exact comparison of members of groups, in blocks of bounded size.

Groups of any size are cut into blocks by a hash; each pair of blocks that can hold a link is one unit of work, so
a hot group feeds many tasks. A unit compares its members by matrix products and reports counts of links and the edges of
a spanning forest, never all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Rows with a null ``other`` carry links of node; the others are edges.
LINKS = "node long, other long, links long"


def own_pairs(salt: Column, blocks: Column) -> Column:
    """The units (i, j), i <= j, in which a member of block ``salt`` of ``blocks`` meets its own group: an array of structs."""
    return F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda s: F.struct(F.least(salt, s).alias("i"), F.greatest(salt, s).alias("j"), (salt == F.greatest(salt, s)).alias("right")))


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges (root, member) that join what the symmetric boolean matrix ``linked`` joins."""
    left, out = np.ones(len(linked), bool), []
    for root in np.flatnonzero(linked.any(1)):
        if not left[root]:
            continue
        left[root] = False
        front = np.array([root])
        while len(front):
            reach = np.flatnonzero(linked[front].any(0) & left)
            left[reach] = False
            out += [(int(root), int(m)) for m in reach]
            front = reach
    return out


def grouped(rows: DataFrame, key: str, compare: Callable[[dict[str, list]], list[tuple]], partitions: int, schema: str = LINKS) -> DataFrame:
    """Runs ``compare`` on the rows of each ``key`` and returns the rows of ``schema`` (columns of type long) that it makes of them.

    ``compare`` gets the columns of one unit of work. Only one unit is held at a time; a unit of one row is none.
    """
    names, out = rows.columns, [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {c: [] for c in names}
        done: list[tuple] = []

        def flush() -> None:
            if len(held[key]) > 1:
                done.extend(compare(held))

        def pack() -> pa.RecordBatch:
            cols = list(zip(*done)) if done else [[]] * len(out)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], out)

        for b in batches:
            cols = {c: b.column(n) for n, c in enumerate(b.schema.names)}
            keys = cols[key].to_pylist()
            start = 0
            for n in range(1, len(keys) + 1):
                if n < len(keys) and keys[n] == keys[start]:
                    continue
                if held[key] and held[key][0] != keys[start]:
                    flush()
                    held = {c: [] for c in names}
                for c in names:
                    held[c] += keys[start:n] if c == key else cols[c][start:n].to_pylist()
                start = n
            if len(done) > 10_000:
                yield pack()
        if held[key]:
            flush()
        yield pack()

    return rows.repartition(partitions, key).sortWithinPartitions(key).mapInArrow(run, schema)


def link_rows(links: dict[int, int], edges: list[tuple]) -> list[tuple]:
    """Rows of ``LINKS``: counts of links by node, with a null other, and edges, with null links or what an edge says of itself besides its ends."""
    return [(n, None, c) for n, c in links.items() if c] + [(*e, None)[:3] for e in edges]

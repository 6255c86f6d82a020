"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

Sources share ``share`` times all words by weight; a source's target stops at ``cap`` times its
own words, and what it leaves is shared by weight among the others. A source whose target is
r times its words gets each document floor(r) times for certain. The rest, a fraction f of
its words, goes to a Pareto order sample of its documents: with U drawn by a hash of the
doc_id, documents rank by (U/(1-U)) / (f/(1-f)), and those are taken from the front whose
words reach the rest, the last one where that brings the sum nearer. One more document then joins or leaves
the sample where its size closes the gap that is left best.

No source is sorted as a whole. Ranks are cut into slices; sums of slices tell in which slice the
sum reaches the rest, and only that slice's documents are ordered one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import Workspace, broadcast_within

WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2
#: Documents in a slice of the ranks, about.
SLICE_ROWS = 2000
#: Rows of sources up to which a join broadcasts them (about 100 bytes each).
MANY_SOURCES = 50_000
_WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)).cast("long"), F.lit(0).cast("long"))


def uniform(doc_id: Column, seed: int) -> Column:
    """A number in (0, 1) drawn by the MD5 of seed and doc_id: 48 of its bits, which any engine can recompute."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))), 1, 12), 16, 10)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(source, source_size, docs, target) by source of ``sizes`` (source, size); weights repeat over sources by code point, null last.

    The level at which uncapped sources stand is found by ordering sources by cap over weight: a source is
    capped if sharing what is left of all words among it and those after it would exceed its cap.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (nth % len(weights) + 1).cast("int")))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    up_to, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    left = F.lit(float(share)) * total - float(cap) * F.coalesce(F.sum("source_size").over(up_to), F.lit(0))
    s = s.withColumns({"left": left, "of": F.sum("weight").over(after)})
    s = s.withColumn("capped", F.col("weight") * F.col("left") >= F.lit(float(cap)) * F.col("source_size") * F.col("of"))
    # the first source in order that is not capped stands for all after it
    free = F.min(F.when(~F.col("capped"), F.struct(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source", "left", "of"))).over(Window.partitionBy())
    s = s.withColumns({"l": free["left"], "o": free["of"]})
    target = F.when(F.col("capped"), F.lit(float(cap)) * F.col("source_size")).otherwise(F.col("weight") * F.col("l") / F.col("o"))
    return s.select("source", "source_size", "docs", target.alias("target"))


def mix(spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP, seed: int = 0, keep: tuple[str, ...] = (), row: str | None = None) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, and source or row where ``keep`` names them) for each row of ``docs`` (doc_id, text, source); other columns are ignored.

    Null and empty texts have size 0 and are never taken; a source of such documents has target 0. The null source is a source.
    Rows that repeat a doc_id draw the same number and are ordered by size; equal rows may trade places. A null
    doc_id draws as the string null does. An empty table gives an empty result. Reruns agree: every draw is a hash.
    Texts of any length are counted whole. ``row`` may name a column that numbers the rows of ``docs``; else they are numbered as they are read.
    """
    ws = Workspace(spark, "mix")
    number = F.col(row) if row else F.monotonically_increasing_id()
    d = ws.table(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), uniform(F.col("doc_id"), seed).alias("u"), number.alias("row")), "sizes")
    s = source_targets(d, weights, share, cap)
    whole = F.least(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(cap)).cast("long")
    s = s.withColumn("whole", F.coalesce(whole, F.lit(0).cast("long")))
    s = s.withColumn("rest", F.when(F.col("whole") < cap, F.col("target") - F.col("whole") * F.col("source_size")).otherwise(0.0))
    s = s.withColumns({"f": F.coalesce(F.try_divide(F.col("rest"), F.col("source_size")), F.lit(0.0)), "slices": F.floor(F.col("docs") / SLICE_ROWS) + 1})
    s = ws.table(s, "sources")
    many = s.count()

    def with_sources(rows: DataFrame, sources: DataFrame) -> DataFrame:
        b = broadcast_within(sources.withColumnRenamed("source", "_s"), many, MANY_SOURCES)
        return rows.join(b, rows["source"].eqNullSafe(b["_s"]), "left").drop("_s")

    odds = F.col("u") / (1 - F.col("u"))
    q = F.when(F.col("f") > 0, odds / (F.col("f") / (1 - F.col("f"))))
    # one source's documents share f, so slices of U are slices of the ranks
    d = with_sources(d, s).withColumns({"q": q, "slice": F.floor(F.col("u") * F.col("slices"))})
    sums = d.where("f > 0").groupBy("source", "slice").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    by = Window.partitionBy("source").orderBy("slice")
    sums = sums.withColumn("before", F.sum("words").over(by) - F.col("words"))
    cut = sums.where("before <= rest AND before + words > rest").groupBy("source").agg(F.min_by(F.struct("slice", "before"), "slice").alias("c"))
    cut = ws.table(cut.select("source", F.col("c.slice").alias("cut"), F.col("c.before").alias("before")), "cuts")
    d = with_sources(d, cut)
    inside = d.where("f > 0 AND slice = cut")
    # a slice holds about SLICE_ROWS documents of its source
    cum = F.sum("size").over(Window.partitionBy("source").orderBy("q", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1))
    gone = F.col("before") + F.coalesce(cum, F.lit(0))
    inside = inside.withColumn("hit", 2 * gone + F.col("size") <= 2 * F.col("rest"))
    outside = d.where("f <= 0 OR f IS NULL OR cut IS NULL OR slice <> cut").withColumn("hit", (F.col("f") > 0) & (F.col("cut").isNull() | (F.col("slice") < F.col("cut"))))
    d = ws.table(inside.unionByName(outside).select("doc_id", "source", "size", "source_size", "target", "whole", "rest", "f", "u", "row", F.coalesce("hit", F.lit(False)).alias("hit")), "sample")
    got = d.where("f > 0").groupBy("source").agg(F.sum(F.when(F.col("hit"), F.col("size")).otherwise(0)).alias("got"), F.first("rest").alias("rest"))
    got = ws.table(got.select("source", (F.col("rest") - F.col("got")).alias("gap")), "gaps")
    g = with_sources(d.where("f > 0"), got)
    fits = (F.abs(F.col("gap")) > F.abs(F.abs(F.col("gap")) - F.col("size"))) & (F.col("hit") == (F.col("gap") < 0))
    best = g.where(fits).groupBy("source").agg(F.min_by("row", F.struct(F.abs(F.abs(F.col("gap")) - F.col("size")), "u", "doc_id", "size", "row")).alias("swap"))
    best = ws.table(best, "swaps")
    out = with_sources(d, best)
    hit = F.when(F.col("row") == F.col("swap"), ~F.col("hit")).otherwise(F.col("hit"))
    copies = F.when(F.col("size") > 0, F.coalesce(F.col("whole"), F.lit(0)) + hit.cast("long")).otherwise(F.lit(0).cast("long"))
    return out.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies"), *keep)


def mixed(spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP, seed: int = 0) -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as ``mix`` takes it.

    Rows are written once with numbers of their own, so rows that repeat, or have no doc_id, are taken row by row and the mix is exact.
    """
    rows = Workspace(spark, "mix").table(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    taken = mix(spark, rows, weights, share, cap, seed, keep=("row",), row="_row").where("copies > 0")
    taken = taken.select(F.col("row").alias("_r"), F.col("copies").alias("_copies"))
    return rows.join(taken, F.col("_row") == F.col("_r")).select(*(F.col(c) for c in docs.columns), F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy")).drop("_copy")

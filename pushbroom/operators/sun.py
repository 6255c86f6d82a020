"""Sun geometry: clocks of lines and interpolation in time series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import radiometry as R

#: Knots up to which a time series is broadcast to the lines.
MANY_KNOTS = 100_000


#: Rows of a table by line or by sample up to which it is broadcast.
MANY_LINES = 500_000


def small(df: DataFrame, limit: int = MANY_LINES) -> DataFrame:
    """``df`` with a broadcast hint if it is counted to have at most ``limit`` rows."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def line_times(spark: SparkSession, start: float, step_ms: float, lines: int, reverse: bool = False) -> DataFrame:
    """(line, t): a clock from ``start`` seconds. ``reverse`` counts it from the last line."""
    n = F.col("id") if not reverse else F.lit(lines - 1) - F.col("id")
    return spark.range(lines).select(F.col("id").alias("line"), (F.lit(float(start)) + F.lit(step_ms / 1000) * n).alias("t"))


def segments(knots: DataFrame, t: str, values: list[str], keys: tuple[str, ...] = ()) -> DataFrame:
    """Pieces between successive distinct knots, the outer ones open: (keys, lo, hi, t0, t1, v0_*, v1_*).

    Knots at equal times count once, by their mean.
    """
    once = knots.groupBy(*keys, t).agg(*(F.avg(v).alias(v) for v in values))
    w = Window.partitionBy(*keys).orderBy(t) if keys else Window.partitionBy(F.lit(0)).orderBy(t)
    nxt = lambda c: F.lead(c).over(w)
    s = once.select(*keys, F.col(t).alias("t0"), nxt(t).alias("t1"), F.row_number().over(w).alias("n"), F.lead(t, 2).over(w).alias("t2"), *(c for v in values for c in (F.col(v).alias(f"v0_{v}"), nxt(v).alias(f"v1_{v}"))))
    s = s.where("t1 IS NOT NULL")
    lo, hi = F.when(F.col("n") > 1, F.col("t0")), F.when(F.col("t2").isNotNull(), F.col("t1"))
    return s.select(*keys, lo.alias("lo"), hi.alias("hi"), "t0", "t1", *(f"v{k}_{v}" for v in values for k in (0, 1)))


def interpolate_at(rows: DataFrame, knots: DataFrame, t: str, values: list[str], keys: tuple[str, ...] = (), knot_t: str = "timestamp", beyond: bool = True) -> DataFrame:
    """Adds each of ``values`` interpolated linearly in time, and extrapolated ``beyond`` both ends from the outer pieces; else rows beyond are left out.

    A row needs two knots to meet a piece. Few knots are broadcast; many are cut into spans of time, so the range join keeps an equality.
    """
    s = segments(knots, knot_t, values, keys)
    n = s.count()
    r = rows.withColumnRenamed(t, "_t")
    meet = F.lit(True)
    for k in keys:
        meet = meet & (r[k] == s[k])
    inside = (F.col("lo").isNull() | (F.col("_t") >= F.col("lo"))) & (F.col("hi").isNull() | (F.col("_t") < F.col("hi")))
    if not beyond:
        inside = inside & F.col("_t").between(F.col("t0"), F.col("t1"))
    if n <= MANY_KNOTS:
        joined = r.join(F.broadcast(s), meet & inside)
    else:
        span = s.agg(((F.max("t1") - F.min("t0")) / F.lit(n)).alias("w"), F.min("t0").alias("a"), F.max("t1").alias("b")).first()
        cell = lambda c: F.floor((F.least(F.greatest(c, F.lit(span.a)), F.lit(span.b)) - F.lit(span.a)) / F.lit(span.w))
        s2 = s.withColumn("_c", F.explode(F.sequence(cell(F.coalesce("lo", F.lit(span.a))), cell(F.coalesce("hi", F.lit(span.b))))))
        joined = r.withColumn("_c", cell(F.col("_t"))).join(s2, "_c").where(inside & meet)
    out = {v: F.col(f"v0_{v}") + (F.col("_t") - F.col("t0")) * (F.col(f"v1_{v}") - F.col(f"v0_{v}")) / (F.col("t1") - F.col("t0")) for v in values}
    return joined.select(*(r[c] for c in rows.columns if c != t), F.col("_t").alias(t), *(e.alias(v) for v, e in out.items()))


def illumination(lines: DataFrame, spm: DataFrame, descending: bool = False) -> DataFrame:
    """Adds inc and iaz (degrees) to ``lines`` (line, t) from a sun-parameter series."""
    at = interpolate_at(lines, spm, "t", ["sun_elev", "sun_az"])
    az = F.col("sun_az") - 180.0 if descending else F.col("sun_az")
    return at.withColumns({"inc": R.incidence(F.col("sun_elev")), "iaz": az}).drop("sun_elev", "sun_az")

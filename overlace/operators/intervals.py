"""Interval algebra on long tables ``(key..., beg, fin)``: islands, sweeps, joins, complements.

All are windows or aggregates partitioned by the read; nothing is expanded to bases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from overlace.functions.scalar import floor_div, intersection


def islands(df: DataFrame, by: list[str], *, dist: int = 0) -> DataFrame:
    """``df`` with an island number: intervals that overlap, touch or lie within ``dist``."""
    before = W.partitionBy(*by).orderBy("beg", "fin").rowsBetween(W.unboundedPreceding, -1)
    upto = W.partitionBy(*by).orderBy("beg", "fin").rowsBetween(W.unboundedPreceding, 0)
    starts = F.when(F.col("beg") > F.max("fin").over(before) + dist, 1).otherwise(0)
    return df.withColumn("_starts", starts).withColumn("island", F.sum("_starts").over(upto)).drop("_starts")


def merge(df: DataFrame, by: list[str], *, dist: int = 0) -> DataFrame:
    """Merged intervals: (by..., beg, fin, n)."""
    return islands(df, by, dist=dist).groupBy(*by, "island").agg(F.min("beg").alias("beg"), F.max("fin").alias("fin"), F.count("*").alias("n")).drop("island")


def covered(df: DataFrame, by: list[str]) -> DataFrame:
    """Bases aligned and bases covered: (by..., bases, covered)."""
    total = merge(df, by).groupBy(*by).agg(F.sum(F.col("fin") - F.col("beg")).alias("covered"))
    return df.groupBy(*by).agg(F.sum(F.col("fin") - F.col("beg")).alias("bases")).join(total, by)


def sweep(df: DataFrame, by: list[str], *, last: int = 0) -> DataFrame:
    """Coverage after each event: +1 at ``beg``, -1 at ``fin - last``; a -1 comes before a +1 at one place.

    Returns (by..., pos, delta, cov), one row per event.
    """
    events = df.select(*by, F.explode(F.array(F.struct(F.col("beg").alias("pos"), F.lit(1).alias("delta")), F.struct((F.col("fin") - last).alias("pos"), F.lit(-1).alias("delta")))).alias("e")).select(*by, "e.pos", "e.delta")
    # Equal events are interchangeable, so the running sum by rows has one result.
    rows = W.partitionBy(*by).orderBy("pos", "delta").rowsBetween(W.unboundedPreceding, 0)
    return events.withColumn("cov", F.sum("delta").over(rows))


def interval_join(left: DataFrame, right: DataFrame, on: str = "rid", *, width: int = 2000, how: str = "inner") -> DataFrame:
    """Rows of ``left`` (beg, fin) with the intersecting ones of ``right`` (beg, fin -> o_beg, o_fin).

    Both sides are cut to bins of ``width``, so that one hot read spreads over many keys;
    a pair is reported by the bin in which its intersection begins.
    """
    bins = lambda b, e: F.explode(F.sequence(floor_div(b, width), floor_div(e - 1, width)))
    a = left.where("fin > beg").withColumn("_bin", bins(F.col("beg"), F.col("fin")))
    o = right.where("fin > beg").withColumnsRenamed({"beg": "o_beg", "fin": "o_fin"})
    o = o.withColumn("_bin", bins(F.col("o_beg"), F.col("o_fin")))
    met = a.join(o, [on, "_bin"]).where((F.col("beg") < F.col("o_fin")) & (F.col("o_beg") < F.col("fin")) & (floor_div(F.greatest("beg", "o_beg"), width) == F.col("_bin")))
    return met.drop("_bin")


def intersect_sums(left: DataFrame, right: DataFrame, key: str, on: str = "rid") -> DataFrame:
    """Per ``key`` of ``left``: bases in, and the longest intersection with, ``right``; 0 without any."""
    size = intersection(F.col("beg"), F.col("fin"), F.col("o_beg"), F.col("o_fin"))
    sums = interval_join(left, right, on).groupBy(key).agg(F.sum(size).alias("inside"), F.max(size).alias("longest"))
    return left.select(key).join(sums, key, "left").select(key, F.coalesce("inside", F.lit(0)).alias("inside"), F.coalesce("longest", F.lit(0)).alias("longest"))


def complement(df: DataFrame, spans: DataFrame, on: str = "rid", *, shortest: int = 1) -> DataFrame:
    """What the intervals leave of each span (rid, lo, hi), stretches of ``shortest`` bases or more: (rid, beg, fin)."""
    clipped = df.join(spans, on).select(on, F.greatest("beg", "lo").alias("beg"), F.least("fin", "hi").alias("fin")).where("fin > beg")
    edges = spans.where("hi > lo").select(on, F.explode(F.array(F.struct(F.col("lo").alias("beg"), F.col("lo").alias("fin")), F.struct(F.col("hi").alias("beg"), F.col("hi").alias("fin")))).alias("e")).select(on, "e.beg", "e.fin")
    solid = merge(clipped.unionByName(edges), [on])
    after = F.lead("beg").over(W.partitionBy(on).orderBy("beg"))
    return solid.withColumn("next", after).where(F.col("next") - F.col("fin") >= shortest).select(on, F.col("fin").alias("beg"), F.col("next").alias("fin"))


def hysteresis(events: DataFrame, by: list[str], enter: Column, leave: Column) -> DataFrame:
    """Intervals from where coverage first exceeds ``enter`` to where it falls below ``leave``: (by..., beg, fin)."""
    rows = W.partitionBy(*by).orderBy("pos", "delta")
    state = F.when(F.col("cov") > enter, 1).when(F.col("cov") < leave, 0)
    held = events.withColumn("state", F.coalesce(F.last(state, ignorenulls=True).over(rows.rowsBetween(W.unboundedPreceding, 0)), F.lit(0)))
    edge = held.withColumn("before", F.coalesce(F.lag("state").over(rows), F.lit(0))).where("state != before")
    numbered = edge.withColumn("n", F.row_number().over(W.partitionBy(*by, "state").orderBy("pos", "delta")))
    return numbered.groupBy(*by, "n").agg(F.min(F.when(F.col("state") == 1, F.col("pos"))).alias("beg"), F.max(F.when(F.col("state") == 0, F.col("pos"))).alias("fin")).where("fin > beg").drop("n")


def stab_counts(points: DataFrame, spans: DataFrame, by: list[str]) -> DataFrame:
    """(by..., pos, n): how many of the spans [beg, fin], both ends in, hold each distinct point (pos).

    One sort of points and ends together, so a read with many spans costs no pairs.
    """
    event = lambda pos, kind, step: F.struct(F.col(pos).cast("long").alias("pos"), F.lit(kind).alias("kind"), F.lit(step).alias("step"))
    ends = spans.where("fin >= beg").select(*by, F.explode(F.array(event("beg", 0, 1), event("fin", 2, -1))).alias("e"))
    asked = points.select(*by, "pos").distinct().select(*by, event("pos", 1, 0).alias("e"))
    rows = W.partitionBy(*by).orderBy("e.pos", "e.kind").rowsBetween(W.unboundedPreceding, 0)
    return ends.unionByName(asked).withColumn("n", F.sum("e.step").over(rows)).where("e.kind = 1").select(*by, "e.pos", "n")


def concat_blocks(blocks: list[DataFrame], by: str = "rid") -> DataFrame:
    """One table of per-block tables; an error if a read is in two blocks. Each needs the same columns."""
    whole = blocks[0].withColumn("block", F.lit(0))
    for k, block in enumerate(blocks[1:], 1):
        whole = whole.unionByName(block.withColumn("block", F.lit(k)))
    clash = whole.groupBy(by).agg(F.count_distinct("block").alias("n")).where("n > 1").select(by).limit(5).collect()
    if clash:
        raise ValueError(f"in two blocks: {', '.join(str(r[0]) for r in clash)}")
    return whole.drop("block")

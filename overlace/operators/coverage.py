"""Coverage sweeps, repeat masks and expected coverage over overlaps."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from overlace.functions.scalar import floor_div, has, with_flag
from overlace.operators import intervals as I  # noqa: E741


def a_side(ovl: DataFrame) -> DataFrame:
    """Kept, non-self overlaps as intervals on their A read: (rid, ovl_id, beg, fin)."""
    return ovl.where(~has(F.col("flags"), "discard") & (F.col("aread") != F.col("bread"))).select(F.col("aread").alias("rid"), "ovl_id", F.col("ab").alias("beg"), F.col("ae").alias("fin"))


def coverage_sweep(ovl: DataFrame) -> DataFrame:
    """Coverage of every A read after each event; an overlap ends at its last base."""
    return I.sweep(a_side(ovl), ["rid"], last=1)


def repeats(ovl: DataFrame, cov: float, *, high: float = 2.0, low: float = 1.7, dist: int = 0) -> DataFrame:
    """The repeat track: coverage above ``high * cov`` until below ``low * cov``, merged within ``dist``.

    Thresholds are cut to integers first.
    """
    found = I.hysteresis(coverage_sweep(ovl), ["rid"], F.lit(int(high * cov)), F.lit(int(low * cov)))
    return I.merge(found, ["rid"], dist=dist).select("rid", "beg", "fin")


def extend_to_ends(track: DataFrame, ovl: DataFrame, *, near: int = 1000, slack: int = 200, more_than: int = 2) -> DataFrame:
    """Repeats near a read end reach it when more than ``more_than`` overlaps begin there and end by the repeat's other end."""
    side = ovl.where(~has(F.col("flags"), "discard")).select(F.col("aread").alias("rid"), "ab", "ae", "alen")
    # Ends within ``slack`` of a repeat's end are counted by one sweep, not by pairs.
    around = lambda x: ((F.col(x) - slack).alias("beg"), (F.col(x) + slack).alias("fin"))
    left = I.stab_counts(track.select("rid", F.col("fin").alias("pos")), side.where("ab = 0").select("rid", *around("ae")), ["rid"]).select("rid", F.col("pos").alias("fin"), F.col("n").alias("left"))
    right = I.stab_counts(track.select("rid", F.col("beg").alias("pos")), side.where("ae = alen").select("rid", *around("ab")), ["rid"]).select("rid", F.col("pos").alias("beg"), F.col("n").alias("right"))
    met = track.join(left, ["rid", "fin"]).join(right, ["rid", "beg"]).join(side.groupBy("rid").agg(F.max("alen").alias("alen")), "rid", "left")
    return met.select(
        "rid", F.when((F.col("beg") <= near) & (F.col("left") > more_than), 0).otherwise(F.col("beg")).alias("beg"),
        F.when((F.col("alen") - F.col("fin") <= near) & (F.col("right") > more_than), F.col("alen")).otherwise(F.col("fin")).alias("fin"),
    )


def local_repeats(ovl: DataFrame, *, enter: int, leave: int, dist: int = 0) -> DataFrame:
    """Repeats from overlaps that end inside both reads: overhang on both at the same end."""
    kept = ovl.where(~has(F.col("flags"), "discard") & (F.col("aread") != F.col("bread")))
    comp = has(F.col("flags"), "comp")
    b_left = F.when(comp, F.col("blen") - F.col("be")).otherwise(F.col("bb"))
    b_right = F.when(comp, F.col("bb")).otherwise(F.col("blen") - F.col("be"))
    local = ((F.col("ab") > 0) & (b_left > 0)) | ((F.col("alen") - F.col("ae") > 0) & (b_right > 0))
    found = I.hysteresis(I.sweep(a_side(kept.where(local)), ["rid"], last=1), ["rid"], F.lit(enter), F.lit(leave))
    return I.merge(found, ["rid"], dist=dist).select("rid", "beg", "fin")


def tandem_mask(ovl: DataFrame, *, separation: int = 20, span: int = 500) -> DataFrame:
    """Union of the B intervals of self overlaps that lie ``separation`` or less apart and span more than ``span``."""
    own = ovl.where((F.col("aread") == F.col("bread")) & (F.col("ab") - F.col("be") <= separation) & (F.col("ae") - F.col("bb") > span))
    return I.merge(own.select(F.col("aread").alias("rid"), F.col("bb").alias("beg"), F.col("ae").alias("fin")), ["rid"]).select("rid", "beg", "fin")


def read_coverage(ovl: DataFrame, reads: DataFrame | None = None) -> DataFrame:
    """Per read: bases aligned, bases covered, and their quotient cut to an integer."""
    side = a_side(ovl) if reads is None else a_side(ovl).join(reads.where("best = 1").select("rid"), "rid", "left_semi")
    return I.covered(side, ["rid"]).withColumn("cov", floor_div(F.col("bases"), F.col("covered")))


def mode_coverage(ovl: DataFrame, reads: DataFrame | None = None, *, below: int = 100) -> DataFrame:
    """One row: the most frequent coverage below ``below``, the lowest of ties, and how many reads have it."""
    counts = read_coverage(ovl, reads).where(F.col("cov") < below).groupBy("cov").agg(F.count("*").alias("reads"))
    return counts.agg(F.max(F.struct("reads", (-F.col("cov")).alias("c"))).alias("m")).select((-F.col("m.c")).alias("cov"), F.col("m.reads").alias("reads"))


def gap_bins(ovl: DataFrame, *, width: int = 100, clear: int = 450) -> DataFrame:
    """(rid, bin, n): overlaps that clear each bin by ``clear`` bases; only bins that some do."""
    first, last = floor_div(F.col("beg") + clear + width - 1, width), floor_div(F.col("fin") - clear, width) - 1
    some = a_side(ovl).withColumn("_a", first).withColumn("_b", last).where("_b >= _a")
    return some.select("rid", F.explode(F.sequence("_a", "_b")).alias("bin")).groupBy("rid", "bin").agg(F.count("*").alias("n"))


def breaks(ovl: DataFrame, *, width: int = 100, clear: int = 450, at_most: int = 1) -> DataFrame:
    """(rid, beg, fin): runs of bins that at most ``at_most`` overlaps clear, between well-covered bins."""
    strong = gap_bins(ovl, width=width, clear=clear).where(F.col("n") > at_most)
    after = F.lead("bin").over(W.partitionBy("rid").orderBy("bin"))
    return strong.withColumn("next", after).where("next > bin + 1").select("rid", ((F.col("bin") + 1) * width).alias("beg"), (F.col("next") * width).alias("fin"))


def window_gaps(ovl: DataFrame, *, step: int = 1000, anchor: int = 200, at_least: int = 2) -> DataFrame:
    """Reads with a step position that fewer than ``at_least`` distinct B reads span by ``anchor`` on both sides: (rid, pos, n)."""
    kept = ovl.where(~has(F.col("flags"), "discard") & (F.col("aread") != F.col("bread")))
    spans = kept.groupBy("aread", "bread").agg(F.min("ab").alias("beg"), F.max("ae").alias("fin"))
    steps = kept.groupBy(F.col("aread").alias("rid")).agg(F.max("alen").alias("alen")).where(F.col("alen") > 2 * step).select("rid", F.explode(F.expr(f"sequence({step}L, cast(alen - {step} as bigint), {step}L)")).alias("pos"))
    first, last = floor_div(F.col("beg") + anchor + step - 1, step), floor_div(F.col("fin") - anchor, step)
    over = spans.withColumn("_a", first).withColumn("_b", last).where("_b >= _a").select(F.col("aread").alias("rid"), F.explode(F.sequence("_a", "_b")).alias("k")).groupBy("rid", (F.col("k") * step).alias("pos")).agg(F.count("*").alias("n"))
    return steps.join(over, ["rid", "pos"], "left").withColumn("n", F.coalesce("n", F.lit(0))).where(F.col("n") < at_least)


def tip_coverage(ovl: DataFrame, trim: DataFrame, *, least: int = 2) -> DataFrame:
    """Per read: overlaps that reach the left and the right trim end, and effective coverage in tenths; ``bad`` below ``least``."""
    side = a_side(ovl).join(trim, "rid")
    counts = side.groupBy("rid").agg(F.count_if(F.col("beg") <= F.col("tb")).alias("left"), F.count_if(F.col("fin") >= F.col("te")).alias("right"))
    cov = I.covered(side, ["rid"]).select("rid", floor_div(F.col("bases") * 10, F.col("covered")).alias("cov10"))
    return counts.join(cov, "rid").withColumn("bad", (F.col("left") == 0) | (F.col("right") == 0) | (F.col("cov10") < least * 10))


def walls(ovl: DataFrame, *, seg: int = 100, at_least: int = 5, within: int = 12000) -> DataFrame:
    """Chimeric reads: a bin where overlaps end early, a later one where others begin late, and none across.

    Returns (rid, end_wall, begin_wall).
    """
    side = ovl.where(~has(F.col("flags"), "discard") & (F.col("aread") != F.col("bread")))
    ends = side.where("ae < alen").groupBy(F.col("aread").alias("rid"), floor_div(F.col("ae"), seg).alias("bin")).agg(F.count("*").alias("n"))
    begs = side.where("ab > 0").groupBy(F.col("aread").alias("rid"), floor_div(F.col("ab"), seg).alias("bin")).agg(F.count("*").alias("n"))

    def wall(bins):
        w = W.partitionBy("rid").orderBy("bin")
        two = F.when(F.lead("bin").over(w) == F.col("bin") + 1, F.col("n") + F.lead("n").over(w)).otherwise(F.col("n"))
        return bins.withColumn("n2", two).where(F.col("n2") >= at_least).select("rid", "bin")

    pairs = wall(ends).withColumnRenamed("bin", "e").join(wall(begs).withColumnRenamed("bin", "b"), "rid").where((F.col("b") >= F.col("e")) & ((F.col("b") - F.col("e")) * seg <= within))
    spans = pairs.select("rid", "e", "b", (F.col("e") * seg).alias("beg"), ((F.col("b") + 1) * seg).alias("fin"))
    across = side.select(F.col("aread").alias("rid"), F.col("ab").alias("beg"), F.col("ae").alias("fin"))
    crossed = I.interval_join(spans, across).where("o_beg < beg and o_fin > fin").select("rid", "e", "b")
    return pairs.join(crossed.distinct(), ["rid", "e", "b"], "left_anti").select("rid", (F.col("e") * seg).alias("end_wall"), (F.col("b") * seg).alias("begin_wall"))


def chimer_spans(ovl: DataFrame, *, fewest: int = 1, anchor: int = 100) -> DataFrame:
    """Reads with an overlap end that fewer than ``fewest`` overlaps span by ``anchor`` on both sides: (rid, pos, spanning)."""
    side = a_side(ovl)
    spans = side.select("rid", (F.col("beg") + anchor).alias("beg"), (F.col("fin") - anchor).alias("fin"))
    counts = I.stab_counts(side.select("rid", F.col("fin").alias("pos")), spans, ["rid"])
    return counts.select("rid", "pos", F.col("n").alias("spanning")).where(F.col("spanning") < fewest)


def walked_chimers(ovl: DataFrame, trim: DataFrame, *, fewest: int = 1, anchor: int = 100) -> DataFrame:
    """Reads whose overlaps don't hold together: (rid, pos, why), ``pos`` where a walk stopped.

    ``why`` is "overlaps" for a read with fewer than ``fewest`` of them, "ends" where fewer than
    ``fewest`` begin at the first covered position or end at the last one, and "gap" where the
    walk breaks off. The walk stands at the end of the longest overlap that begins first. It reads
    the overlaps once, in order; when ``fewest`` of those read since its last move span its place by
    ``anchor`` bases on both sides (less near the ends), it moves to the farthest end among all that
    spanned so far. It is whole if it stands at the last covered position before the overlaps are
    used up. The first and last position count within the trim. Discarded overlaps don't take part;
    a read of discarded ones only, or without any inside its trim, isn't named but for "overlaps".

    A task keeps five numbers for the read that it is at, however many overlaps the read has.
    """
    alive = ovl.where(~has(F.col("flags"), "discard")).select(F.col("aread").alias("rid"), "bread", (F.col("flags").bitwiseAND(1)).alias("comp"), "ab", "ae", "bb", "be", "ovl_id")
    total = ovl.groupBy(F.col("aread").alias("rid")).agg(F.count("*").alias("n"))
    few = total.where(F.col("n") < fewest).select("rid", F.lit(None).cast("long").alias("pos"), F.lit("overlaps").alias("why"))
    ends = alive.groupBy("rid").agg(F.min("ab").alias("lo"), F.max("ae").alias("hi")).join(trim, "rid").where("lo < te").withColumn("hi", F.greatest("hi", "tb")).select("rid", "lo", "hi")
    ends = ends.join(total.where(F.col("n") >= fewest), "rid").drop("n")
    starts = alive.join(ends, "rid").groupBy("rid", "lo", "hi").agg(F.count_if(F.col("ab") == F.col("lo")).alias("first"), F.count_if(F.col("ae") == F.col("hi")).alias("last"), F.max(F.when(F.col("ab") == F.col("lo"), F.col("ae"))).alias("at"))
    loose = (F.col("first") < fewest) | (F.col("last") < fewest)
    walks = starts.where(~loose & (F.col("at") < F.col("hi"))).select("rid", "lo", "hi", "at")
    order = ["rid", "bread", "comp", "ab", "ae", "bb", "be", "ovl_id"]
    given = alive.join(walks, "rid").repartition("rid").sortWithinPartitions(*order).select("rid", "ab", "ae", *(F.col(c).cast("long") for c in ("lo", "hi", "at")))

    def run(batches):
        walk = None  # rid, place, farthest end, spanning since the last move, whole
        for batch in batches:
            stopped = []
            for rid, rows in batch.groupby("rid", sort=False):
                if walk is None or walk[0] != rid:
                    stopped += _stopped(walk)
                    at = int(rows["at"].iloc[0])
                    walk = (rid, at, at, 0, False)
                walk = _walk(walk, rows["ab"].to_numpy(), rows["ae"].to_numpy(), int(rows["lo"].iloc[0]), int(rows["hi"].iloc[0]), fewest, anchor)
            yield pd.DataFrame(stopped, columns=["rid", "pos", "why"])
        yield pd.DataFrame(_stopped(walk), columns=["rid", "pos", "why"])

    broken = given.mapInPandas(run, "rid long, pos long, why string")
    return few.unionByName(starts.where(loose).select("rid", F.lit(None).cast("long").alias("pos"), F.lit("ends").alias("why"))).unionByName(broken)


def _stopped(walk: tuple | None) -> list[tuple]:
    return [] if walk is None or walk[4] else [(walk[0], walk[1], "gap")]


def _walk(walk: tuple, ab: np.ndarray, ae: np.ndarray, lo: int, hi: int, fewest: int, anchor: int) -> tuple:
    """The walk after more overlaps of its read."""
    rid, at, far, seen, whole = walk
    i = 0
    while i < len(ab) and not whole:
        if at == hi:
            whole = True
            break
        spans = np.flatnonzero((ab[i:] <= at - min(anchor, at - lo)) & (ae[i:] >= at + min(anchor, hi - at)))[: fewest - seen]
        if len(spans):
            far = max(far, int(ae[i:][spans].max()))
        if len(spans) < fewest - seen:
            seen += len(spans)
            break
        i, at, seen = i + int(spans[-1]) + 1, far, 0
    return rid, at, far, seen, whole


def shorter_twins(ovl: DataFrame) -> DataFrame:
    """(ovl_id) of overlaps that meet a longer one of the same pair on A; of equally long ones the first in order stays."""
    pair = W.partitionBy("aread", "bread")
    order = ("comp", "ab", "ae", "bb", "be", "ovl_id")
    own = ovl.withColumn("comp", F.col("flags").bitwiseAND(1)).withColumn("_n", F.count("*").over(pair)).where("_n > 1").withColumn("_k", F.row_number().over(pair.orderBy(*order)))
    own = own.select(F.struct("aread", "bread").alias("pair"), "ovl_id", "_k", F.col("ab").alias("beg"), F.col("ae").alias("fin"))
    met = I.interval_join(own, own.select("pair", "beg", "fin", F.col("_k").alias("o_k")), "pair")
    size, other = F.col("fin") - F.col("beg"), F.col("o_fin") - F.col("o_beg")
    return met.where((other > size) | ((other == size) & (F.col("o_k") < F.col("_k")))).select("ovl_id").distinct()


def _enclosed(breaks_: DataFrame, spans: DataFrame) -> DataFrame:
    """(rid, beg) of the breaks that lie strictly inside one of the spans (rid, lo, hi): one sort of both, no pairs."""
    events = spans.select("rid", F.col("lo").cast("long").alias("beg"), F.lit(1).alias("kind"), F.col("hi").cast("long").alias("hi"), F.lit(None).cast("long").alias("fin"))
    events = events.unionByName(breaks_.select("rid", F.col("beg").cast("long").alias("beg"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("hi"), F.col("fin").cast("long").alias("fin")))
    before = W.partitionBy("rid").orderBy("beg", "kind").rowsBetween(W.unboundedPreceding, 0)
    return events.withColumn("most", F.max("hi").over(before)).where("kind = 0 and most > fin").select("rid", "beg")


def weak_runs(ovl: DataFrame, *, exclude: DataFrame | None = None, fuzz: int = 0, width: int = 100, clear: int = 450, at_most: int = 1) -> DataFrame:
    """(rid, beg, fin, at_end, kept): runs of bins that at most ``at_most`` overlaps clear, one bin wider at both sides.

    Bins count from the first to the last place that the read's overlaps clear; of overlaps of one pair that
    meet, the longest counts. A run before the end is ``kept``, no break, if an interval of ``exclude`` encloses
    it or, with ``fuzz`` > 0, two overlaps of a pair and strand do that nearly meet: the second begins within
    ``fuzz`` bases of the first one's end on both reads, and both reach ``clear`` bases beyond the run.
    """
    alive = ovl.where(~has(F.col("flags"), "discard") & (F.col("aread") != F.col("bread")))
    twins = shorter_twins(alive)
    side = a_side(alive.join(twins, "ovl_id", "left_anti")).withColumn("b", floor_div(F.col("beg") + clear, width)).withColumn("e", floor_div(F.col("fin") - clear, width))
    whole = side.groupBy("rid").agg(F.min("b").alias("lo"), F.max("e").alias("hi")).where("hi > lo")
    event = lambda at, step: F.struct(F.col(at).alias("bin"), F.lit(step).alias("step"))
    steps = side.where("e > b").select("rid", F.explode(F.array(event("b", 1), event("e", -1))).alias("x")).unionByName(whole.select("rid", F.explode(F.array(event("lo", 0), event("hi", 0))).alias("x")))
    steps = steps.groupBy("rid", "x.bin").agg(F.sum("x.step").alias("step"))
    row = W.partitionBy("rid").orderBy("bin")
    levels = steps.withColumn("n", F.sum("step").over(row.rowsBetween(W.unboundedPreceding, 0))).withColumn("next", F.lead("bin").over(row))
    runs = I.merge(levels.where((F.col("n") <= at_most) & F.col("next").isNotNull()).select("rid", F.col("bin").alias("beg"), F.col("next").alias("fin")), ["rid"]).join(whole, "rid")
    found = runs.select("rid", ((F.col("beg") - 1) * width).alias("beg"), ((F.col("fin") + 1) * width).alias("fin"), (F.col("fin") == F.col("hi")).alias("at_end"))
    spans = [] if exclude is None else [exclude.select("rid", F.col("beg").alias("lo"), F.col("fin").alias("hi"))]
    if fuzz > 0:
        spans.append(_bridges(ovl.join(twins, "ovl_id", "left_anti"), fuzz, clear))
    if not spans:
        return found.withColumn("kept", F.lit(False))
    inside = _enclosed(found.where("not at_end"), spans[0] if len(spans) == 1 else spans[0].unionByName(spans[1]))
    return found.join(inside.withColumn("kept", F.lit(True)), ["rid", "beg"], "left").select("rid", "beg", "fin", "at_end", F.coalesce("kept", F.lit(False)).alias("kept"))


def _bridges(ovl: DataFrame, fuzz: int, clear: int) -> DataFrame:
    """(rid, lo, hi) of two overlaps of a pair and strand that nearly meet; what lies between ``lo`` and ``hi`` is bridged."""
    pair = ["aread", "bread", "comp"]
    shown = ovl.where(~(has(F.col("flags"), "temp") | has(F.col("flags"), "cont") | has(F.col("flags"), "trim") | has(F.col("flags"), "stitch")))
    own = shown.withColumn("comp", F.col("flags").bitwiseAND(1)).withColumn("_n", F.count("*").over(W.partitionBy(*pair))).where("_n > 1").withColumn("_k", F.row_number().over(W.partitionBy(*pair).orderBy("ab", "ae", "bb", "be", "ovl_id")))
    cell = floor_div(F.col("ae"), fuzz)
    one = own.select(*pair, F.col("_k").alias("k1"), F.col("ab").alias("ab1"), F.col("ae").alias("ae1"), F.col("be").alias("be1"), F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    two = own.select(*pair, F.col("_k").alias("k2"), F.col("ab").alias("ab2"), F.col("ae").alias("ae2"), F.col("bb").alias("bb2"), floor_div(F.col("ab"), fuzz).alias("cell"))
    near = (F.abs(F.col("ae1") - F.col("ab2")) < fuzz) & (F.abs(F.col("be1") - F.col("bb2")) < fuzz) & (F.col("k1") < F.col("k2"))
    return one.join(two, [*pair, "cell"]).where(near).select(F.col("aread").alias("rid"), (F.col("ab1") + clear).alias("lo"), (F.col("ae2") - clear).alias("hi"))


def drop_at_breaks(ovl: DataFrame, runs: DataFrame) -> DataFrame:
    """Overlaps flagged ``gap`` on the side of each break (rid, beg, fin; ``kept`` false) that lacks the read's longest overlap.

    Breaks are taken from left to right and each drop counts for the next. As long as the longest overlap begins
    behind a break, those that begin before it go, and the longest stays. At the first break that it begins before,
    those that end behind go; what is left lies to the left of all later breaks, so that these drop nothing. (With a
    longest overlap of no more than a bin that need not hold.) So two limits a read say what goes.
    """
    best = ovl.where(~has(F.col("flags"), "discard")).groupBy(F.col("aread").alias("rid")).agg(F.min(F.struct((F.col("ab") - F.col("ae")).alias("size"), "bread", F.col("flags").bitwiseAND(1).alias("comp"), "ab", "ae", "bb", "be", "ovl_id")).alias("o")).select("rid", F.col("o.ab").alias("start"))
    limits = runs.where("not kept").join(best, "rid").groupBy("rid").agg(F.max(F.when(F.col("beg") <= F.col("start"), F.col("beg"))).alias("from"), F.min(F.when(F.col("beg") > F.col("start"), F.col("fin"))).alias("to"))
    out = ovl.join(limits.withColumnRenamed("rid", "aread"), "aread", "left")
    gone = F.coalesce(F.col("ab") < F.col("from"), F.lit(False)) | F.coalesce(F.col("ae") > F.col("to"), F.lit(False))
    return out.withColumn("flags", with_flag(F.col("flags"), "gap", gone & ~has(F.col("flags"), "discard"))).select(ovl.columns)

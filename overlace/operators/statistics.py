"""Length, overlap, track and quality statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from overlace.functions.scalar import floor_div, has
from overlace.operators.storage import stored


def read_stats(reads: DataFrame) -> DataFrame:
    """Number of reads, bases, mean and standard deviation of the length, both cut to integers."""
    s = reads.agg(F.count("*").alias("reads"), F.sum("rlen").alias("bases"), F.sum(F.col("rlen") * F.col("rlen")).alias("sq"))
    mean = F.floor(F.col("bases") / F.col("reads"))
    # The deviation is from the cut mean.
    var = (F.col("sq") - 2 * mean * F.col("bases") + F.col("reads") * mean * mean) / F.col("reads")
    return s.select("reads", "bases", mean.cast("long").alias("mean"), F.floor(F.sqrt(var)).cast("long").alias("sd"))


def histogram(df: DataFrame, length: str, *, width: int, genome: int | None = None) -> DataFrame:
    """Per bin of ``length``, from the longest: n, bases, and of it and all longer: reads and bases in percent, mean, coverage of ``genome``.

    The running sums go over one row per bin.
    """
    bins = df.groupBy(floor_div(F.col(length), width).alias("bin")).agg(F.count("*").alias("n"), F.sum(length).alias("bases"))
    from_top, whole = W.orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, 0), W.orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    cum_n, cum_b = F.sum("n").over(from_top), F.sum("bases").over(from_top)
    out = [(F.col("bin") * width).alias("from"), "n", F.round(100.0 * cum_n / F.sum("n").over(whole), 6).alias("pct_reads"), F.round(100.0 * cum_b / F.sum("bases").over(whole), 6).alias("pct_bases"), floor_div(cum_b, cum_n).alias("mean")]
    if genome:
        out.append(F.round(cum_b / genome, 6).alias("coverage"))
    return bins.select(*out)


def overlap_stats(ovl: DataFrame, by: Column) -> DataFrame:
    """Counts per ``by`` and overall (null): overlaps, A reads, B reads, self, forward, complement, mean A length."""
    comp = has(F.col("flags"), "comp")
    named = ovl.withColumn("part", by)
    plain = named.groupBy("part").agg(
        F.count("*").alias("overlaps"), F.count_if(F.col("aread") == F.col("bread")).alias("selfs"), F.count_if(~comp).alias("forward"), F.count_if(comp).alias("complement"),
        F.sum(F.col("ae") - F.col("ab")).alias("bases"), F.count(F.col("ae") - F.col("ab")).alias("known"),
    )
    # Reads are dealt out before they are told apart: a task sees its share of them, once each and part.
    sides = named.select("part", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("aread").alias("rid")), F.struct(F.lit(1).alias("side"), F.col("bread").alias("rid")))).alias("s")).select("part", "s.*")
    seen = sides.where("rid is not null").repartition(int(ovl.sparkSession.conf.get("spark.sql.shuffle.partitions")), "rid").groupBy("rid", "side", "part").agg(F.lit(1).alias("_"))
    seen = seen.groupBy("rid", "side").agg(F.collect_list(F.struct("part")).alias("parts"))
    # One row for each part, and one, without part, for all.
    whole = F.array(F.struct(F.lit(False).alias("one"), F.lit(None).cast(named.schema["part"].dataType).alias("part")))
    levels = lambda parts: F.explode(F.concat(F.transform(parts, lambda x: F.struct(F.lit(True).alias("one"), x["part"].alias("part"))), whole)).alias("l")
    reads = seen.select("side", levels(F.col("parts"))).groupBy(F.col("l.one").alias("o"), F.col("l.part").alias("p")).agg(F.count_if(F.col("side") == 0).alias("areads"), F.count_if(F.col("side") == 1).alias("breads"))
    names = ["overlaps", "selfs", "forward", "complement", "bases", "known"]
    sums = plain.select(levels(F.array(F.struct("part"))), *names).groupBy("l.one", "l.part").agg(*[F.sum(n).alias(n) for n in names])
    out = sums.join(reads, (F.col("one") == F.col("o")) & F.col("part").eqNullSafe(F.col("p")), "left")
    told = lambda n: F.coalesce(n, F.lit(0)).alias(n)
    return out.select("part", "overlaps", told("areads"), told("breads"), "selfs", "forward", "complement", F.floor(F.col("bases") / F.col("known")).cast("long").alias("mean"))


def track_stats(track: DataFrame, *, width: int = 100) -> DataFrame:
    """Per track and bin of interval length: intervals and bases."""
    size = F.col("fin") - F.col("beg")
    return track.groupBy("track", (floor_div(size, width) * width).alias("from")).agg(F.count("*").alias("n"), F.sum(size).alias("bases"))


def segment_quality(trace: DataFrame, ovl: DataFrame, reads: DataFrame, *, best: int = 20, least: int = 1) -> DataFrame:
    """(rid, seg, q) for every 100-base segment: mean of the ``best`` smallest differences of complete
    segments of non-self overlaps, rounded half up; 0 with fewer than ``least``, 1 where it would be 0."""
    pairs = ovl.where(F.col("aread") != F.col("bread")).select("aread", "ovl_id")
    ends = trace.join(reads.select(F.col("rid").alias("aread"), "rlen"), "aread")
    full = ends.where((F.col("a_from") % 100 == 0) & ((F.col("a_to") % 100 == 0) | (F.col("a_to") == F.col("rlen")))).join(pairs, ["aread", "ovl_id"], "left_semi")
    ranked = full.withColumn("k", F.row_number().over(W.partitionBy("aread", "seg").orderBy("d", "ovl_id"))).where(F.col("k") <= best)
    q = ranked.groupBy(F.col("aread").alias("rid"), "seg").agg(F.count("*").alias("n"), F.floor(F.avg("d") + 0.5).cast("long").alias("m"))
    every = reads.select("rid", F.explode(F.expr("sequence(0L, cast(ceil(rlen / 100) as bigint) - 1)")).alias("seg"))
    value = F.when(F.coalesce("n", F.lit(0)) < least, 0).when(F.col("m") == 0, 1).otherwise(F.col("m")).cast("long")
    return every.join(q, ["rid", "seg"], "left").select("rid", "seg", value.alias("q"))


def trim_by_quality(q: DataFrame, reads: DataFrame, *, bad: int = 25, run: int = 5, shortest: int = 1000) -> DataFrame:
    """(rid, tb, te): from the first to the last run of ``run`` good segments (0 < q < bad); (0, 0) below ``shortest`` bases."""
    ahead = W.partitionBy("rid").orderBy("seg").rowsBetween(0, run - 1)
    good = q.withColumn("good", ((F.col("q") > 0) & (F.col("q") < bad)).cast("int")).withColumn("ok", F.sum("good").over(ahead))
    span = good.where(F.col("ok") == run).groupBy("rid").agg((F.min("seg") * 100).alias("tb"), ((F.max("seg") + run) * 100).alias("te"))
    kept = F.col("te") - F.col("tb") >= shortest
    out = reads.select("rid", "rlen").join(span, "rid", "left").withColumn("te", F.least("te", "rlen"))
    return out.select("rid", F.when(kept, F.col("tb")).otherwise(0).cast("long").alias("tb"), F.when(kept, F.col("te")).otherwise(0).cast("long").alias("te"))


def exact_trim(q: DataFrame, *, bad: int = 25, run: int = 5) -> DataFrame:
    """(rid, first, last): the quality trim by its sequential rule, on each read's short array of q values.

    From each end, segments are dropped while they are bad or the mean over ``run`` segments is.
    """

    def scan(values, step):
        i = 0 if step > 0 else len(values) - 1
        while 0 <= i < len(values):
            window = values[i : i + run] if step > 0 else values[max(0, i - run + 1) : i + 1]
            if 0 < values[i] < bad and len(window) == run and window.mean() < bad:
                return i
            i += step
        return -1

    def rule(rows):
        rows = rows.sort_values("seg")
        values = rows["q"].to_numpy()
        first, last = scan(values, 1), scan(values, -1)
        return rows.iloc[:1][["rid"]].assign(first=first if first <= last else -1, last=last if first <= last else -1)

    return q.groupBy("rid").applyInPandas(rule, "rid long, first long, last long")


def tighten_trim(trim: DataFrame, ovl: DataFrame, *, step: int = 100) -> DataFrame:
    """Trims shrunk to the extent of kept non-self overlaps, the left end rounded up to ``step``."""
    kept = ovl.where(~has(F.col("flags"), "discard") & (F.col("aread") != F.col("bread"))).groupBy(F.col("aread").alias("rid")).agg(F.min("ab").alias("lo"), F.max("ae").alias("hi"))
    t = trim.join(kept, "rid", "left").withColumn("b", F.greatest("tb", floor_div(F.col("lo") + step - 1, step) * step)).withColumn("e", F.least("te", "hi"))
    ok = F.col("lo").isNotNull() & (F.col("e") > F.col("b"))
    return t.select("rid", F.when(ok, F.col("b")).otherwise(0).alias("tb"), F.when(ok, F.col("e")).otherwise(0).alias("te"))


def tighten_by_quality(trim: DataFrame, ovl: DataFrame, q: DataFrame, reads: DataFrame, *, bad: int = 25, run: int = 5, shortest: int = 1000) -> DataFrame:
    """(rid, tb, te): a trim that reaches beyond the kept non-self overlaps is made anew, by quality inside their extent.

    The extent's left end is rounded up and its right end down to segments. Trims within the extent stay as they are;
    a read without such overlaps gets (0, 0).
    """
    kept = ovl.where(~has(F.col("flags"), "discard") & (F.col("aread") != F.col("bread"))).groupBy(F.col("aread").alias("rid")).agg(F.min("ab").alias("lo"), F.max("ae").alias("hi"))
    beyond = trim.select("rid", "tb", "te").join(kept, "rid", "left").withColumn("anew", F.col("lo").isNull() | (F.col("tb") < F.col("lo")) | (F.col("te") > F.col("hi")))
    room = beyond.where("anew and lo is not null").select("rid", floor_div(F.col("lo") + 99, 100).alias("first"), floor_div(F.col("hi"), 100).alias("behind"))
    inside = q.join(room, "rid").where("seg >= first and seg < behind").select("rid", "seg", "q")
    made = trim_by_quality(inside, reads, bad=bad, run=run, shortest=shortest).withColumnsRenamed({"tb": "b", "te": "e"})
    end = lambda old, new: F.when(~F.col("anew"), F.col(old)).otherwise(F.coalesce(new, F.lit(0))).cast("long").alias(old)
    return beyond.join(made, "rid", "left").select("rid", end("tb", "b"), end("te", "e"))


def q_histogram(q: DataFrame, trim: DataFrame, anchors: DataFrame, *, shortest: int = 1000, most: int = 100) -> DataFrame:
    """(q, n): values of segments wholly in the trim and in an anchor of at least three segments."""
    wide = anchors.where("fin - beg >= 300")
    s = q.join(trim.where(F.col("te") - F.col("tb") >= shortest), "rid").where("seg * 100 >= tb and seg * 100 + 100 <= te")
    inside = s.join(wide, "rid").where("seg * 100 >= beg and seg * 100 + 100 <= fin").select("rid", "seg", "q").distinct()
    return inside.groupBy(F.least("q", F.lit(most)).alias("q")).agg(F.count("*").alias("n"))


def nx_stats(lengths: DataFrame, *, genome: int) -> DataFrame:
    """(x, n, ng) for x = 10 .. 100: the length at which the longest sequences hold x percent of the bases, and of ``genome``.

    Runs over one row per distinct length, so a single task sees no sequences.
    """
    per = lengths.groupBy("rlen").agg((F.count("*") * F.col("rlen")).alias("bases"))
    total = F.sum("bases").over(W.partitionBy())
    run = F.sum("bases").over(W.orderBy(F.desc("rlen")).rowsBetween(W.unboundedPreceding, 0))
    steps = per.withColumn("run", run).withColumn("total", total).withColumn("x", F.explode(F.array(*(F.lit(x) for x in range(10, 101, 10)))))
    return steps.groupBy("x").agg(
        F.max(F.when(F.col("run") * 100 >= F.col("total") * F.col("x"), F.col("rlen"))).alias("n"),
        F.max(F.when(F.col("run") * 100 >= F.col("x") * F.lit(genome), F.col("rlen"))).alias("ng"),
    )


def pair_stats(pairs: DataFrame, steps: tuple[int, ...] = (1000, 10000, 15000, 20000)) -> DataFrame:
    """All pairs, pairs within one reference, and those at least so far apart, pairs across."""
    same = F.col("ref1") == F.col("ref2")
    far = [F.count_if(same & (F.abs(F.col("pos1") - F.col("pos2")) >= d)).alias(f"intra_{d}") for d in steps]
    return pairs.agg(F.count("*").alias("pairs"), F.count_if(same).alias("intra"), *far, F.count_if(~same).alias("inter"))


def running_sum(df: DataFrame, value: str, name: str, *, width: int = 10_000) -> DataFrame:
    """``df`` with the sum of ``value`` over all rows up to each, in the order of rid: sums per range of ``width`` ids first, then within each."""
    r = df.withColumn("_part", floor_div(F.col("rid"), width))
    before = r.groupBy("_part").agg(F.sum(value).alias("_s")).withColumn("_base", F.sum("_s").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))).select("_part", F.coalesce("_base", F.lit(0)).alias("_base"))
    w = W.partitionBy("_part").orderBy("rid").rowsBetween(W.unboundedPreceding, 0)
    return r.join(before, "_part").withColumn(name, F.col("_base") + F.sum(value).over(w)).drop("_part", "_base")


def next_starts(before: DataFrame, size: int, *, parts: int = 64) -> DataFrame:
    """(rid, next): for a block that begins at a read, the first read of the next one, which is the first whose bases before
    it (``before``: rid, before) are ``size`` more; null without one.

    Reads and the places asked for are sorted together within stretches of size / ``parts``
    bases; a place with no read behind it in its stretch takes the first of those after it.
    """
    width = max(1, size // parts)
    have = before.select(F.col("before").alias("at"), F.lit(1).alias("kind"), "rid")
    ask = before.select((F.col("before") + size).alias("at"), F.lit(0).alias("kind"), "rid")
    both = have.unionByName(ask).withColumn("stretch", floor_div(F.col("at"), width))
    # Frames that end behind all rows are summed anew for every row, those that begin before all rows aren't: so both go from the last row on.
    ahead = W.partitionBy("stretch").orderBy(F.desc("at"), F.desc("kind"), F.desc("rid")).rowsBetween(W.unboundedPreceding, 0)
    found = both.withColumn("next", F.min(F.when(F.col("kind") == 1, F.col("rid"))).over(ahead))
    firsts = both.groupBy("stretch").agg(F.min(F.when(F.col("kind") == 1, F.col("rid"))).alias("first")).withColumn("_group", floor_div(F.col("stretch"), 1000))
    back = lambda by: by.orderBy(F.desc("stretch")).rowsBetween(W.unboundedPreceding, -1)
    behind = firsts.groupBy("_group").agg(F.min("first").alias("_first")).withColumn("_behind", F.min("_first").over(W.orderBy(F.desc("_group")).rowsBetween(W.unboundedPreceding, -1))).select("_group", "_behind")
    later = firsts.withColumn("_later", F.min("first").over(back(W.partitionBy("_group")))).join(behind, "_group").select("stretch", F.coalesce("_later", "_behind").alias("later"))
    return found.where("kind = 0").join(later, "stretch").select("rid", F.coalesce("next", "later").alias("next"))


def exact_blocks(reads: DataFrame, size: int) -> DataFrame:
    """(rid, block): reads in id order; a block ends with the read that brings its own bases to ``size`` or more.

    Every read points at where the next block would begin if one began there; the blocks
    that there are follow from the first read by pointer doubling, in as many rounds as the
    number of blocks has bits.
    """
    sums = stored(running_sum(reads.select("rid", "rlen"), "rlen", "upto").select("rid", (F.col("upto") - F.col("rlen")).alias("before")))
    jump = stored(next_starts(sums, size).where("next is not null"))
    starts = stored(sums.agg(F.min("rid").alias("rid")).where("rid is not null"))
    n = starts.count()
    while True:
        more = stored(starts.unionByName(starts.join(jump, "rid").select(F.col("next").alias("rid"))).distinct())
        starts, before, n = more, n, more.count()
        if n == before:
            break
        far = jump.select(F.col("rid").alias("next"), F.col("next").alias("far"))
        jump = stored(jump.join(far, "next").select("rid", F.col("far").alias("next")))
    flagged = sums.select("rid").join(starts.withColumn("first", F.lit(1)), "rid", "left").withColumn("first", F.coalesce("first", F.lit(0)))
    return running_sum(flagged, "first", "n").select("rid", (F.col("n") - 1).cast("long").alias("block"))


def blocks(reads: DataFrame, size: int) -> DataFrame:
    """(rid, block): reads in id order by running bases; a block ends with the read that passes a multiple of ``size``.

    The running sum is by ranges of ids: sums per range of 10,000 ids first, then within each.
    """
    r = reads.withColumn("part", floor_div(F.col("rid"), 10_000))
    before = r.groupBy("part").agg(F.sum("rlen").alias("s")).withColumn("base", F.sum("s").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))).select("part", F.coalesce("base", F.lit(0)).alias("base"))
    w = W.partitionBy("part").orderBy("rid").rowsBetween(W.unboundedPreceding, -1)
    return r.join(before, "part").select("rid", floor_div(F.col("base") + F.coalesce(F.sum("rlen").over(w), F.lit(0)), size).alias("block"))


def slow_regions(subreads: DataFrame) -> DataFrame:
    """(well, frag): subreads whose share of slow bases, on a log scale, is above mean + 2 sd of all."""
    x = F.log((F.col("slow_bases") + 1) / (F.col("ins_end") - F.col("ins_beg")))
    s = subreads.withColumn("x", x)
    fit = s.agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("sd"))
    return s.crossJoin(F.broadcast(fit)).where("x > m + 2 * sd").select("well", "frag")  # one row of fit


def hq_subreads(subreads: DataFrame, *, shortest: int = 500) -> DataFrame:
    """Subreads clipped to the high-quality window: (well, frag, beg, fin)."""
    s = subreads.select("*", F.greatest("ins_beg", "hq_beg").alias("beg"), F.least("ins_end", "hq_end").alias("fin"))
    return s.where(F.col("fin") - F.col("beg") >= shortest)


def best_subread(subreads: DataFrame, how: str = "best") -> DataFrame:
    """One subread per well, the longest, shortest or best, where best weighs length in the HQ window (0.2), quality (0.4) and share of non-slow bases (0.4)."""
    size = F.col("fin") - F.col("beg")
    score = 0.2 * size / (F.col("hq_end") - F.col("hq_beg")) + 0.4 * F.col("avg_qv") / F.max("avg_qv").over(W.partitionBy("well")) + 0.4 * (1 - F.col("slow_bases") / size)
    order = {"best": F.desc("score"), "longest": F.desc("size"), "shortest": F.asc("size")}[how]
    s = hq_subreads(subreads).withColumn("size", size).withColumn("score", score)
    return s.withColumn("k", F.row_number().over(W.partitionBy("well").orderBy(order, "frag"))).where("k = 1").select("well", "frag", "beg", "fin")


def subread_report(subreads: DataFrame, *, width: int = 500) -> DataFrame:
    """Per bin of length: subreads, bases, wells, mean quality."""
    s = hq_subreads(subreads, shortest=1)
    size = F.col("fin") - F.col("beg")
    return s.groupBy((floor_div(size, width) * width).alias("from")).agg(F.count("*").alias("n"), F.sum(size).alias("bases"), F.count_distinct("well").alias("wells"), F.round(F.avg("avg_qv"), 6).alias("qv"))

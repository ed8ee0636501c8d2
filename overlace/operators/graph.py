"""Overlap graphs: edges, components, neighbourhoods, unitig paths and their sequences.

Edges are (src, dst, side, ovh, div); side l or r is the end of ``src`` that the edge leaves.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from overlace.functions.scalar import reverse_complement
from overlace.operators.overlaps import comp, discarded, with_trim
from overlace.operators.storage import stored


def drop_parallel(ovl: DataFrame) -> DataFrame:
    """Kept overlaps of pairs that have just one."""
    return ovl.where(~discarded()).withColumn("_n", F.count("*").over(W.partitionBy("aread", "bread"))).where("_n = 1").drop("_n")


def classify(ovl: DataFrame, trim: DataFrame) -> DataFrame:
    """(rid, kind): contained where an overlap covers the read's whole trim, even a discarded one; proper with an edge; else widow."""
    t = with_trim(ovl.where("aread != bread"), trim)
    a_in = (F.col("ab") <= F.col("ta_b")) & (F.col("ae") >= F.col("ta_e"))
    b_in = (F.col("bb") <= F.col("tb_b")) & (F.col("be") >= F.col("tb_e"))
    seen = t.select(F.explode(F.array(F.struct(F.col("aread").alias("rid"), a_in.alias("c")), F.struct(F.col("bread").alias("rid"), (b_in & ~a_in).alias("c")))).alias("x")).select("x.*")
    contained = seen.groupBy("rid").agg(F.bool_or("c").alias("c"))
    linked = edges(ovl, trim).select(F.explode(F.array("src", "dst")).alias("rid")).distinct().withColumn("e", F.lit(True))
    out = trim.select("rid").join(contained, "rid", "left").join(linked, "rid", "left")
    return out.select("rid", F.when(F.coalesce("c", F.lit(False)), "contained").when(F.col("e"), "proper").otherwise("widow").alias("kind"))


def edges(ovl: DataFrame, trim: DataFrame) -> DataFrame:
    """Edges of kept, non-self overlaps: from A's trim begin on its left side, from its trim end on its right, and the reverse edges.

    The overhang is what B has beyond; without one there is no edge. The reverse edge
    leaves B's other side, or the same side on complemented overlaps, with A's rest as overhang.
    """
    t = with_trim(ovl.where(~discarded() & (F.col("aread") != F.col("bread"))), trim).withColumn("c", comp().cast("int"))
    div = F.floor(100.0 * 2 * F.col("diffs") / (F.col("ae") - F.col("ab") + F.col("be") - F.col("bb"))).cast("long").alias("div")

    def one(at_end, side, over, back_over):
        hit = t.where(at_end).withColumn("ovh", over).withColumn("back", back_over)
        fwd = hit.where("ovh > 0").select("ovl_id", F.col("aread").alias("src"), F.col("bread").alias("dst"), F.lit(side).alias("side"), "ovh", "c", div)
        other = "r" if side == "l" else "l"
        rev = hit.where("ovh > 0 and back > 0").select("ovl_id", F.col("bread").alias("src"), F.col("aread").alias("dst"), F.when(F.col("c") == 1, side).otherwise(other).alias("side"), F.col("back").alias("ovh"), "c", div)
        return fwd.unionByName(rev)

    left = one(F.col("ab") == F.col("ta_b"), "l", F.col("bb") - F.col("tb_b"), F.col("ta_e") - F.col("ae"))
    return left.unionByName(one(F.col("ae") == F.col("ta_e"), "r", F.col("tb_e") - F.col("be"), F.col("ab") - F.col("ta_b")))


def remove_duplicates(edge: DataFrame) -> DataFrame:
    """One edge per target and side, the last by (ovh, div); of a target on both sides the left one stays."""
    last = W.partitionBy("src", "dst", "side").orderBy(F.desc("ovh"), F.desc("div"))
    one = edge.withColumn("_k", F.row_number().over(last)).where("_k = 1").drop("_k")
    both = one.where("side = 'l'").select("src", "dst", F.lit("r").alias("side"))
    return one.join(both, ["src", "dst", "side"], "left_anti")


def dead_ends(edge: DataFrame) -> DataFrame:
    """Vertices without an edge on one side: (rid, open), the side that is open."""
    sides = edge.groupBy(F.col("src").alias("rid")).agg(F.count_if(F.col("side") == "l").alias("l"), F.count_if(F.col("side") == "r").alias("r"))
    return sides.where("l = 0 or r = 0").select("rid", F.when(F.col("l") == 0, "l").otherwise("r").alias("open"))


def drop_inversions(edge: DataFrame) -> DataFrame:
    """Edges without those to a target that is reached on both sides of a vertex."""
    twice = edge.groupBy("src", "dst").agg(F.count_distinct("side").alias("n")).where("n > 1").select("src", "dst")
    return edge.join(twice, ["src", "dst"], "left_anti")


def vertex_quality(edge: DataFrame) -> DataFrame:
    """(rid, quality): 1 / min(10, edges) for each side and mean divergence / 1000."""
    part = lambda s: F.when(F.col(s) == 0, 1.0).otherwise(1 / F.least(F.lit(10), s))
    sides = edge.groupBy(F.col("src").alias("rid")).agg(F.count_if(F.col("side") == "l").alias("l"), F.count_if(F.col("side") == "r").alias("r"), F.avg("div").alias("div"))
    return sides.select("rid", F.round(part("l") + part("r") + F.col("div") / 1000, 9).alias("quality"))


def components(edge: DataFrame) -> DataFrame:
    """(rid, component): the smallest vertex reachable over edges in either direction.

    Each round a vertex takes the smallest label of its neighbours and then that label's own
    label (pointer jumping), so rounds grow with the logarithm of the longest path; each is
    a stored table.
    """
    both = stored(edge.select("src", "dst").unionByName(edge.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    label = stored(both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("low")).select(F.col("src").alias("rid"), "low"))
    while True:
        near = both.join(label.withColumnRenamed("rid", "dst"), "dst").groupBy(F.col("src").alias("rid")).agg(F.min("low").alias("near"))
        met = label.join(near, "rid").select("rid", F.least("low", "near").alias("new"), "low")
        jump = met.join(met.select(F.col("rid").alias("new"), F.col("new").alias("far")), "new", "left")
        following = stored(jump.select("rid", F.least("new", F.coalesce("far", "new")).alias("low"), (F.least("new", F.coalesce("far", "new")) != F.col("low")).alias("moved")))
        label = following.select("rid", "low")
        if not following.where("moved").limit(1).count():
            return label.withColumnRenamed("low", "component")


def neighbourhood(edge: DataFrame, start: DataFrame, hops: int) -> DataFrame:
    """(rid, hop): vertices within ``hops`` edges of the start vertices, and the fewest edges."""
    found = start.select("rid").distinct().withColumn("hop", F.lit(0))
    front = found
    step = edge.select("src", "dst").distinct()
    for hop in range(1, hops + 1):
        front = front.join(step, front["rid"] == step["src"]).select(F.col("dst").alias("rid")).distinct().join(found.select("rid"), "rid", "left_anti").withColumn("hop", F.lit(hop))
        found = stored(found.unionByName(front))
        front = found.where(F.col("hop") == hop)
    return found


#: Starts in a block, at least; blocks, at most: a block's task holds the edges that its starts can come to.
STARTS, BLOCKS = 4_096, 64


def _around(lists: DataFrame, starts: DataFrame, edges: int) -> DataFrame:
    """(block, side, src, ends, start): of every block of starts (block, side, rid) the vertices less than ``edges`` edges away,
    with their targets from ``lists`` (src, side, ends). Every third edge is a table."""
    found = starts.select("block", "side", F.col("rid").alias("src"), F.lit(True).alias("start"))
    for done in range(1, edges):
        ahead = found.join(lists, ["src", "side"]).select("block", "side", F.explode("ends").alias("src"), F.lit(False).alias("start"))
        found = found.unionByName(ahead).groupBy("block", "side", "src").agg(F.bool_or("start").alias("start"))
        if done % 3 == 0 or done == edges - 1:
            found = stored(found)
    return found.join(lists, ["src", "side"]).select("block", "side", "src", "ends", "start")


def _visits(at: np.ndarray, dst: np.ndarray, starts: np.ndarray, lookahead: int) -> np.ndarray:
    """For each start the first step of a shortest walk to the most visited vertex (the smallest of equals) of all walks of at
    most ``lookahead`` edges that don't come to the start again. The targets of vertex v are dst[at[v] : at[v + 1]], ascending."""
    times, seen, way = np.zeros(len(at) - 1, np.int64), np.zeros(len(at) - 1, np.int64), np.empty_like(starts)
    for i, start in enumerate(starts.tolist()):
        front = first = dst[at[start] : at[start + 1]]
        n, of, levels = np.ones(len(front), np.int64), np.arange(len(front)), []
        for depth in range(1, lookahead + 1):
            np.add.at(times, front, n)
            levels.append((front, first, of))
            if depth == lookahead:
                break
            # A front is in the order of first steps, and so is what is ahead of it: the first row of a vertex has its least.
            row = np.arange(len(front))
            seen[front[::-1]] = row[::-1]
            one, total = seen[front], np.zeros(len(front), np.int64)
            np.add.at(total, one, n)
            one = np.flatnonzero(one == row)
            front, first, n = front[one], first[of[one]], total[one]
            count = at[front + 1] - at[front]
            of = np.repeat(np.arange(len(front)), count)
            front = dst[np.arange(len(of)) + np.repeat(at[front] - np.cumsum(count) + count, count)]
            if (front == start).any():
                of, front = of[front != start], front[front != start]
            if not len(front):
                break
            n = n[of]
        met = np.concatenate([x for x, _, _ in levels])
        visited = times[met]
        best = met[visited == visited.max()].min()
        times[met] = 0
        way[i] = next(b[o[k[0]]] for a, b, o in levels if len(k := np.flatnonzero(a == best)))
    return way


def best_next(edge: DataFrame, *, lookahead: int = 6, leaving: DataFrame | None = None) -> DataFrame:
    """(rid, side, next): of all walks of at most ``lookahead`` edges that leave by one side and go on
    by it, the most visited vertex (the smallest of equals); ``next`` is the first step of a shortest walk to it.

    Walks are many more than edges, so they are no rows: starts are dealt to blocks, a block gathers the edges that its
    starts can come to, and its task counts walks by vertex and depth. ``leaving``, (rid, side), names the starts; all without it.
    """
    lists = stored(edge.groupBy("src", "side").agg(F.array_sort(F.collect_set("dst")).alias("ends")))
    starts = lists.select(F.col("src").alias("rid"), "side")
    if leaving is not None:
        starts = starts.join(leaving.select("rid", "side"), ["rid", "side"], "left_semi")
    blocks = min(BLOCKS, max(1, -(-starts.count() // (2 * STARTS))))

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ends, side = table.column("ends").combine_chunks(), table.column("side")[0].as_py()
        src, to = table.column("src").to_numpy(), ends.flatten().to_numpy()
        ids = np.unique(np.concatenate([src, to]))
        own, size = np.searchsorted(ids, src), ends.value_lengths().to_numpy().astype(np.int64)
        count = np.zeros(len(ids), np.int64)
        count[own] = size
        at = np.concatenate([[0], np.cumsum(count)])
        dst = np.empty(len(to), np.int64)
        dst[np.arange(len(to)) + np.repeat(at[own] - np.cumsum(size) + size, size)] = np.searchsorted(ids, to)
        rid = own[table.column("start").combine_chunks().to_numpy(zero_copy_only=False)]
        return pa.table({"rid": ids[rid], "side": pa.array([side] * len(rid), pa.string()), "next": ids[_visits(at, dst, rid, lookahead)]})

    dealt = starts.select("rid", "side", F.pmod(F.xxhash64("rid"), F.lit(blocks)).alias("block"))
    held = _around(lists, dealt, lookahead).repartition(2 * blocks, "block", "side")
    return held.groupBy("block", "side").applyInArrow(run, "rid long, side string, next long")


def unitigs(chosen: DataFrame) -> DataFrame:
    """(path, pos, rid): chains of vertices that choose each other, on the right and on the left.

    Pointer doubling along predecessors gives every vertex its chain's head and its place.
    Vertices that never reach a head lie on cycles, which are cut before their smallest id.
    """
    right = chosen.where("side = 'r'").select("rid", F.col("next").alias("to"))
    left = chosen.where("side = 'l'").select(F.col("rid").alias("to"), F.col("next").alias("rid"))
    links = right.join(left, ["rid", "to"])
    every = chosen.select("rid").distinct()
    first = stored(every.join(links.select(F.col("to").alias("rid"), F.col("rid").alias("back")), "rid", "left"))
    done = _double(first, every.count())
    loops = done.where("back is not null").select("rid", "low")
    if loops.limit(1).count():
        cut = first.join(loops, "rid").select("rid", F.when(F.col("rid") != F.col("low"), F.col("back")).alias("back"))
        done = done.where("back is null").unionByName(_double(stored(cut), every.count()))
    return done.select(F.col("head").alias("path"), F.col("far").cast("long").alias("pos"), "rid")


def _double(back: DataFrame, n: int) -> DataFrame:
    """(rid, back, head, far, low) after enough doublings of the back pointers for ``n`` vertices."""
    state = back.select("rid", "back", F.coalesce("back", "rid").alias("head"), F.when(F.col("back").isNull(), 0).otherwise(1).cast("long").alias("far"), F.least("rid", F.coalesce("back", "rid")).alias("low"))
    for _ in range(max(1, n.bit_length())):
        if not state.where("back is not null").limit(1).count():
            break
        over = state.select(F.col("rid").alias("back"), F.col("back").alias("b2"), F.col("head").alias("h2"), F.col("far").alias("f2"), F.col("low").alias("l2"))
        state = stored(
            state.join(over, "back", "left").select(
                "rid", F.col("b2").alias("back"), F.coalesce("h2", "head").alias("head"), (F.col("far") + F.coalesce("f2", F.lit(0))).alias("far"), F.least("low", F.coalesce("l2", "low")).alias("low")
            )
        )
    return state


def path_ends(paths: DataFrame) -> DataFrame:
    """(path, first, last, n)."""
    return paths.groupBy("path").agg(F.min_by("rid", "pos").alias("first"), F.max_by("rid", "pos").alias("last"), F.count("*").alias("n"))


def path_joins(paths: DataFrame, edge: DataFrame) -> DataFrame:
    """(path, follows): a path's last vertex has an edge to the other's first, and neither end has another partner."""
    e = path_ends(paths)
    step = edge.where("side = 'r'").select("src", "dst").distinct()
    met = e.select(F.col("path"), F.col("last").alias("src")).join(step, "src").join(e.select(F.col("path").alias("follows"), F.col("first").alias("dst")), "dst").where("path != follows").select("path", "follows").distinct()
    alone = (F.count("*").over(W.partitionBy("path")) == 1) & (F.count("*").over(W.partitionBy("follows")) == 1)
    return met.withColumn("_ok", alone).where("_ok").drop("_ok")


def joined_paths(paths: DataFrame, edge: DataFrame) -> DataFrame:
    """(path, pos, rid): paths joined end to end by ``path_joins``, again and again until no two ends are each other's only partners."""
    edge = stored(edge.where("side = 'r'").select("src", "dst", "side").distinct())
    while True:
        joins = stored(path_joins(paths, edge))
        if not joins.limit(1).count():
            return paths
        # A run of joined paths is a chain of pointers; a ring of them is cut before its smallest path.
        ends = path_ends(paths).select(F.col("path").alias("rid"), "n")
        first = stored(ends.select("rid").join(joins.select(F.col("follows").alias("rid"), F.col("path").alias("back")), "rid", "left"))
        done = _double(first, first.count())
        loops = stored(done.where("back is not null").select("rid", "low"))
        if loops.limit(1).count():
            cut = stored(first.join(loops, "rid").select("rid", F.when(F.col("rid") != F.col("low"), F.col("back")).alias("back")))
            done = done.where("back is null").unionByName(_double(cut, cut.count()))
        order = W.partitionBy("head").orderBy("far").rowsBetween(W.unboundedPreceding, -1)
        placed = done.join(ends, "rid").withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0))).select(F.col("rid").alias("path"), "head", "before")
        paths = stored(paths.join(placed, "path").select(F.col("head").alias("path"), (F.col("pos") + F.col("before")).alias("pos"), "rid"))


def end_labels(paths: DataFrame, chosen: DataFrame) -> DataFrame:
    """(path, end1, end2): the path that the first vertex's choice on the left, and the last one's on the right, lies on; -1 where it is free or on the path itself."""
    e = path_ends(paths)
    on = paths.select(F.col("rid").alias("next"), F.col("path").alias("other"))

    def label(end: str, side: str, name: str) -> DataFrame:
        ahead = e.select("path", F.col(end).alias("rid")).join(chosen.where(F.col("side") == side).select("rid", "next"), "rid", "left").join(on, "next", "left")
        return ahead.select("path", F.when(F.coalesce("other", "path") == F.col("path"), -1).otherwise(F.col("other")).cast("long").alias(name))

    return label("first", "l", "end1").join(label("last", "r", "end2"), "path")


def sharing_paths(paths: DataFrame, edge: DataFrame, *, more_than: int = 10) -> DataFrame:
    """(p1, p2, shared): pairs of paths with more than so many common targets of their vertices."""
    targets = stored(paths.join(edge.select(F.col("src").alias("rid"), "dst"), "rid").select("path", "dst").distinct())
    x, y = targets.select(F.col("path").alias("p1"), "dst"), targets.select(F.col("path").alias("p2"), "dst")
    return x.join(y, "dst").where("p1 < p2").groupBy("p1", "p2").agg(F.count("*").alias("shared")).where(F.col("shared") > more_than)


def path_sequences(paths: DataFrame, seqs: DataFrame, edge: DataFrame) -> DataFrame:
    """(path, seq): the first read and then each next one's overhang, turned while the path runs on the complement.

    ``edge`` gives ovh and c (1 where the step changes strand) of each step (src, dst, side r); unknown steps add nothing.
    """
    order = W.partitionBy("path").orderBy("pos")
    steps = paths.withColumn("before", F.lag("rid").over(order))
    known = edge.where("side = 'r'").groupBy(F.col("src").alias("before"), F.col("dst").alias("rid")).agg(F.max("ovh").alias("ovh"), F.max("c").alias("c"))
    s = steps.join(known, ["before", "rid"], "left").join(seqs, "rid", "left")
    turned = F.sum(F.coalesce("c", F.lit(0))).over(order.rowsBetween(W.unboundedPreceding, 0)) % 2
    s = s.withColumn("seq", F.coalesce("seq", F.lit(""))).withColumn("side", F.when(turned == 1, reverse_complement(F.col("seq"))).otherwise(F.col("seq")))
    part = F.when(F.col("pos") == 0, F.col("side")).otherwise(F.expr("right(side, cast(least(coalesce(ovh, 0), length(side)) as int))"))
    return s.withColumn("part", part).groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "part"))), lambda x: x["part"]), "").alias("seq"))


def add_contained(edge: DataFrame, kinds: DataFrame, spare: DataFrame, *, per_end: int = 1, rounds: int | None = None) -> DataFrame:
    """Edges with contained reads added, as optional, at sides without a proper edge.

    ``kinds``: (rid, kind); ``spare``: candidate edges (src, dst, side, ovh, div) to contained reads. Each
    round, every open side of a read in use takes up to ``per_end`` of the longest overhang; those reads are in use from then on.
    Rounds go on until one adds nothing, or ``rounds`` of them.

    What an open side takes is the same in every round, so it is found once. A side that is filled stays filled and one that
    finds nothing finds nothing later, so a round looks at the reads that came into use in the one before only.
    """
    cols = ["src", "dst", "side", "ovh", "div"]
    edge = stored(edge.select(*cols))
    best = W.partitionBy("src", "side").orderBy(F.desc("ovh"), "dst")
    takes = spare.join(kinds.where("kind = 'contained'").select(F.col("rid").alias("dst")), "dst", "left_semi").join(edge.select("src", "side").distinct(), ["src", "side"], "left_anti")
    takes = stored(takes.withColumn("_k", F.row_number().over(best)).where(F.col("_k") <= per_end).select(*cols))
    out = edge.withColumn("optional", F.lit(0))
    front = used = stored(edge.select(F.explode(F.array("src", "dst")).alias("rid")).distinct())
    for _ in count() if rounds is None else range(rounds):
        new = stored(takes.join(front.withColumnRenamed("rid", "src"), "src", "left_semi").select(*cols, F.lit(1).alias("optional")))
        if not new.limit(1).count():
            break
        out = out.unionByName(new)
        front = stored(new.select(F.col("dst").alias("rid")).distinct().join(used, "rid", "left_anti"))
        used = used.unionByName(front)
    return out

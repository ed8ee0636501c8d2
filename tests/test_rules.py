"""Hand-made cases of single rules, and sequential rules against plain restatements."""

import random

from overlace.functions import scalar as S
from overlace.operators import chains, graph, intervals, sequences, statistics
from overlace.streaming import masks
from pyspark.sql import functions as F


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_touching_intervals_merge(spark):
    df = spark.createDataFrame([(1, 0, 10), (1, 10, 20), (1, 21, 30), (2, 5, 6)], "rid long, beg long, fin long")
    assert rows(intervals.merge(df, ["rid"]).select("rid", "beg", "fin")) == [(1, 0, 20), (1, 21, 30), (2, 5, 6)]
    assert rows(intervals.merge(df, ["rid"], dist=1).select("rid", "beg", "fin")) == [(1, 0, 30), (2, 5, 6)]


def test_end_comes_before_begin_at_one_place(spark):
    df = spark.createDataFrame([(1, 0, 10), (1, 10, 20)], "rid long, beg long, fin long")
    assert [r.cov for r in intervals.sweep(df, ["rid"]).orderBy("pos", "delta").collect()] == [1, 0, 1, 0]


def test_interval_join_equals_nested_loops(spark):
    rng = random.Random(3)
    a = [(k, k % 3, x := rng.randrange(9000), x + rng.randrange(0, 5000)) for k in range(60)]
    b = [(k % 3, x := rng.randrange(9000), x + rng.randrange(0, 5000)) for k in range(60)]
    got = intervals.interval_join(spark.createDataFrame(a, "k long, rid long, beg long, fin long"), spark.createDataFrame(b, "rid long, beg long, fin long"), width=700)
    want = sorted((k, o, p) for k, r, x, y in a for q, o, p in b if q == r and x < p and o < y and y > x and p > o)
    assert rows(got.select("k", "o_beg", "o_fin")) == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], "rid long, beg long, fin long")
    spans = spark.createDataFrame([(1, 0, 50)], "rid long, lo long, hi long")
    assert rows(intervals.merge(none, ["rid"])) == []
    assert rows(intervals.complement(none, spans)) == [(1, 0, 50)]


def test_scalars(spark):
    df = spark.createDataFrame([("3g", "acgtn"), ("4m", "ACGT"), ("5k", ""), ("7", "a"), ("x", None)], "t string, s string")
    got = df.select(S.parse_bp(F.col("t")), S.reverse_complement(F.col("s")), S.format_bp(F.lit(5_300_000))).collect()
    assert [tuple(r) for r in got] == [(3_000_000_000, "nacgt", "5m"), (4_000_000, "ACGT", "5m"), (5000, "", "5m"), (7, "t", "5m"), (None, None, "5m")]


def test_components_of_a_long_path_and_a_ring(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    ring = [(1, 2), (2, 3), (3, 1)]
    got = dict(rows(graph.components(spark.createDataFrame(path + ring, "src long, dst long"))))
    assert {got[i] for i in range(100, 141)} == {100} and {got[i] for i in (1, 2, 3)} == {1}


def test_unitigs_cut_rings_at_the_smallest_vertex(spark):
    chosen = [(5, "r", 6), (6, "l", 5), (6, "r", 7), (7, "l", 6), (1, "r", 2), (2, "l", 1), (2, "r", 3), (3, "l", 2), (3, "r", 1), (1, "l", 3), (9, "r", 5)]
    got = rows(graph.unitigs(spark.createDataFrame(chosen, "rid long, side string, next long")).select("path", "pos", "rid"))
    assert got == [(1, 0, 1), (1, 1, 2), (1, 2, 3), (5, 0, 5), (5, 1, 6), (5, 2, 7), (9, 0, 9)]


def test_chains_follow_the_rule(spark):
    cols = "ovl_id long, aread long, bread long, flags int, ab long, ae long, bb long, be long, diffs long, alen long, blen long"
    data = [(1, 1, 2, 0, 0, 100, 0, 100, 1, 999, 999), (2, 1, 2, 0, 150, 300, 160, 310, 1, 999, 999), (3, 1, 2, 0, 160, 200, 170, 210, 1, 999, 999), (4, 1, 2, 1, 320, 400, 330, 410, 1, 999, 999), (5, 1, 3, 0, 5, 9, 5, 9, 0, 999, 999)]
    got = rows(chains.chain(spark.createDataFrame(data, cols)))
    assert got == [(1, 0, 0), (2, 0, 1), (4, 1, 0), (5, 0, 0)]


def test_exact_trim_equals_a_restatement(spark):
    rng = random.Random(5)
    q = [(r, s, rng.choice([0, 5, 12, 20, 24, 30, 44])) for r in range(12) for s in range(40)]
    got = {r[0]: r[1:] for r in rows(statistics.exact_trim(spark.createDataFrame(q, "rid long, seg long, q long")))}
    for rid in range(12):
        v = [x for r, _, x in q if r == rid]
        good = [i for i in range(len(v)) if 0 < v[i] < 25]
        first = next((i for i in good if i + 5 <= len(v) and sum(v[i : i + 5]) / 5 < 25), -1)
        last = next((i for i in reversed(good) if i >= 4 and sum(v[i - 4 : i + 1]) / 5 < 25), -1)
        assert got[rid] == ((first, last) if first <= last else (-1, -1))


def test_long_read_chunks_cover_all(spark):
    df = spark.createDataFrame([(1, "a" * 950), (2, "a" * 1000), (3, "a" * 2100), (4, "a" * 4321)], "rid long, seq string")
    for rid, n in ((1, 950), (2, 1000), (3, 2100), (4, 4321)):
        c = sequences.split_long(df.where(F.col("rid") == rid), 1000, 100).orderBy("beg").collect()
        assert c[0].beg == 0 and c[-1].fin == n and all(y.beg == x.fin - 100 and x.fin - x.beg <= 1000 for x, y in zip(c, c[1:]))


def test_a_stream_resumes_and_drops_repeats(spark, tmp_path):
    cols = "ovl_id long, aread long, bread long, flags int, ab long, ae long, bb long, be long, diffs long, alen long, blen long"
    one = [(1, 1, 2, 0, 0, 100, 0, 100, 1, 999, 999), (2, 1, 3, 0, 50, 150, 0, 100, 1, 999, 999)]
    two = [(2, 1, 3, 0, 50, 150, 0, 100, 1, 999, 999), (3, 1, 4, 0, 60, 90, 0, 30, 1, 999, 999), (4, 1, 4, 0, 90, 120, 30, 60, 1, 999, 999)]
    places = [str(tmp_path / x) for x in ("in", "hits", "state")]
    for part in (one, two):
        df = spark.createDataFrame(part, cols)
        df.coalesce(1).write.mode("append").parquet(places[0])
        masks.accumulate(masks.ingest(spark, places[0], df.schema), places[1], places[2])
    found = masks.read_hits(spark, places[1])
    assert found.count() == 3
    assert rows(masks.masks(found, above=2)) == [(1, 60, 100)]


def test_components_of_all_edges_equal_union_find(spark):
    from helpers import SMALL

    from overlace.plans import registry
    from overlace.plans.fixtures import view

    registry.load()
    parent = {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for src, dst in view(spark, SMALL, "f_graph").select("src", "dst").collect():
        a, b = find(parent.setdefault(src, src)), find(parent.setdefault(dst, dst))
        parent[max(a, b)] = min(a, b)
    got = {r.rid: r.component for r in registry.QUERIES["g6_components_all"](spark, SMALL).collect()}
    assert got == {x: find(x) for x in parent}

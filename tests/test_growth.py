"""Steps whose cost must follow the input: what is looked at once, called for many groups at a time, or never spread out."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from overlace.operators import chains, contigs, graph, overlaps, statistics


def test_contained_reads_are_looked_up_once(spark):
    looked = spark.sparkContext.accumulator(0)

    def seen(rows):
        for frame in rows:
            looked.add(len(frame))
            yield frame

    n = 12  # a chain of contained reads, one joins in each round
    cols = "src long, dst long, side string, ovh long, div long"
    edge = spark.createDataFrame([(0, 1, "l", 5, 1), (0, 1, "r", 5, 1), (1, 0, "l", 5, 1)], cols)
    spare = spark.createDataFrame([(i, i + 1, "r", 9, 1) for i in range(1, n)], cols).mapInPandas(seen, cols)
    kinds = spark.createDataFrame([(i, "contained") for i in range(2, n + 1)], "rid long, kind string")
    got = {(r.src, r.dst, r.optional) for r in graph.add_contained(edge, kinds, spare).collect()}
    assert got == {(0, 1, 0), (1, 0, 0)} | {(i, i + 1, 1) for i in range(1, n)}
    assert looked.value <= n


def test_scans_get_many_whole_reads_at_a_time(spark):
    calls = spark.sparkContext.accumulator(0)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    spark.conf.set(name, "100")
    ovl = spark.range(3000).selectExpr("id div 7 as aread", "id % 5 as bread")

    def function(rows):
        calls.add(1)
        return rows.groupby("aread").agg(n=("bread", "size")).reset_index()

    got = {r.aread: r.n for r in overlaps.overlap_scan(ovl, function, "aread long, n long").collect()}
    spark.conf.set(name, old)
    assert got == {a: min(7, 3000 - 7 * a) for a in range(429)}
    assert calls.value < 100


def test_chains_of_two_overlaps():
    rng = np.random.default_rng(5)
    n, names = 4000, ["comp", "ab", "ae", "bb", "be", "ovl_id", "score"]
    ab, bb = rng.integers(0, 12, n) * 300, rng.integers(0, 12, n) * 300
    frame = pd.DataFrame({"comp": rng.integers(0, 2, n), "ab": ab, "ae": ab + rng.integers(1, 6, n) * 300, "bb": bb, "be": bb + rng.integers(1, 6, n) * 300, "ovl_id": rng.permutation(n), "score": rng.integers(0, 5, n) * 300})[names]
    frame.loc[1:400:2, names[:5]] = frame.loc[0:399:2, names[:5]].to_numpy()  # equal ones
    at = np.arange(0, n, 2)
    for least in (None, 500):
        got = sorted(chains._chain_twos(frame, at, 600, least).itertuples(index=False, name=None))
        assert got == sorted(x for i in at for x in chains.chain_pair(frame.iloc[i : i + 2], 600, least))


def test_bins_of_long_overlaps_are_not_made(spark):
    far = 10**12
    ovl = spark.createDataFrame([(i, 1, 2 + i, 0, 0, far, 0, far, far) for i in range(2)], "ovl_id long, aread long, bread long, flags long, ab long, ae long, bb long, be long, blen long")
    trim = spark.createDataFrame([(i, 0, 2 * far) for i in range(1, 4)], "rid long, tb long, te long")
    got = chains.repeat_modules(ovl, trim, spark.createDataFrame([(1, 1000, 3000)], "rid long, beg long, fin long")).collect()
    assert [tuple(r) for r in got] == [(1, 2000, 2100)]


def test_pairs_are_dealt_out_before_they_are_counted(spark, monkeypatch):
    monkeypatch.setattr(contigs, "PAIRS", 100)
    rows = spark.range(40).selectExpr("id as contig", "id % 2 as rid")
    got = contigs.shared_reads(rows)
    assert {(r.c1, r.c2, r.shared) for r in got.collect()} == {(i, j, 1) for i in range(40) for j in range(i + 2, 40, 2)}
    assert "Arguments: hashpartitioning(c1" in got._jdf.queryExecution().toString() or "hashpartitioning(c1#" in got._jdf.queryExecution().toString()
    assert ", 4), REPARTITION_BY_NUM" in got._jdf.queryExecution().toString()


def test_distinct_reads_are_dealt_out_by_read(spark):
    ovl = spark.createDataFrame([(1, 2, 0, 0, 10), (1, 3, 1, 0, 21), (2, 2, 1, 5, 10), (None, 2, 0, 0, 10)], "aread long, bread long, flags long, ab long, ae long")
    got = statistics.overlap_stats(ovl, F.when(F.col("bread") == 2, "x"))
    assert {tuple(r) for r in got.collect()} == {("x", 3, 2, 1, 1, 2, 1, 8), (None, 1, 1, 1, 0, 0, 1, 21), (None, 4, 2, 2, 1, 2, 2, 11)}
    # No row is spread to one for each level and distinct count.
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()


def test_walks_are_counted_not_listed(spark):
    # Seven layers, each vertex leads to all of the next one: 60**6 walks from each vertex of the first.
    n, layers = 60, 7
    edge = spark.range(n * n * (layers - 1)).selectExpr(f"id div {n} as src", f"(id div {n * n} + 1) * {n} + id % {n} as dst", "'l' as side")
    got = {r.rid: r.next for r in graph.best_next(edge).collect()}
    assert got == {v: (v // n + 1) * n for v in range(n * (layers - 1))}

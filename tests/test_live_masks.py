"""Masks kept as state against masks from scratch."""

import random

import numpy as np
from pyspark.sql import functions as F

from overlace.streaming import masks

SCHEMA = "ovl_id long, aread long, bread long, flags long, ab long, ae long, alen long, blen long"


def made(rng, n, reads):
    out = []
    for i in range(n):
        a, b = rng.choice(reads), rng.randrange(12)
        ab = rng.choice([0, rng.randrange(0, 900)])
        ae = rng.choice([1000, min(1000, ab + rng.randrange(1, 500))])
        out.append((i, a, b, 2 * (i % 11 == 0), ab, ae, 1000, rng.choice([900, 1000, 1100])))
    return out


def plain(rows, above, ends):
    want = set()
    for r in {x[1] for x in rows}:
        kept = [x for x in rows if x[1] == r and not x[3] & 2 and x[1] != x[2]]
        per = {}
        for x in kept:
            per.setdefault(x[2], set()).update(range(max(ends, x[4]), min(1000 - ends, x[5])))
        cov = [sum(p in s for s in per.values()) for p in range(1001)]
        beg = None
        for p in range(1001):
            if cov[p] > above and beg is None:
                beg = p
            elif cov[p] <= above and beg is not None:
                want.add((r, "maskr", beg, p))
                beg = None
        if any(x[4] == 0 and x[5] == 1000 and (x[7] > 1000 or (x[7] == 1000 and x[2] < r)) for x in kept):
            want.add((r, "maskc", 0, 1000))
    return want


def test_state_by_read_equals_masks_from_scratch(spark, tmp_path):
    rng = random.Random(5)
    blocks = [made(rng, 120, [0, 1, 2, 20]), made(rng, 60, [2, 3]), made(rng, 60, [4, 30])]
    blocks[1] = [(i + 1000, *x) for i, *x in blocks[1]] + blocks[0][:30]  # some again
    blocks[2] = [(i + 2000, *x) for i, *x in blocks[2]]
    table, state = f"{tmp_path}/masks", f"{tmp_path}/state"
    seen = []
    for k, block in enumerate(blocks):
        spark.createDataFrame(block, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/blocks")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/blocks")
        masks.live_masks(stream, table, state, above=3, ends=20)
        seen += block
        assert set(map(tuple, masks.read_masks(spark, table).collect())) == plain(seen, 3, 20)
        touched = {r.rid for r in spark.read.parquet(f"{table}/batch={k}").select("rid").distinct().collect()}
        assert touched == {x[1] for x in block if not x[3] & 2 and x[1] != x[2]}
    assert masks.read_masks(spark, table).where(F.col("track") == "maskr").count() > 5


def test_intervals_join_by_b_read():
    got = masks.united(np.array([2, 1, 1, 1, 2]), np.array([5, 0, 10, 11, 0]), np.array([9, 10, 12, 11, 4]))
    assert [x.tolist() for x in got] == [[1, 2, 2], [0, 0, 5], [12, 4, 9]]
    assert [x.tolist() for x in masks.united(*(np.zeros(0, np.int64),) * 3)] == [[], [], []]
    assert masks.covered_above(np.array([0, 5, 10]), np.array([10, 10, 20]), 0) == [(0, 20)] and masks.covered_above(np.array([0, 5]), np.array([10, 8]), 1) == [(5, 8)]


def test_reads_share_a_state(spark, tmp_path, monkeypatch):
    """State is by group of reads, not by read, and the reads of a group keep apart."""
    monkeypatch.setattr(masks, "GROUPS", 3)
    rows = made(random.Random(8), 900, list(range(20, 60)))
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/blocks")
    query = masks.live_masks(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/blocks"), f"{tmp_path}/masks", f"{tmp_path}/state", above=4)
    assert set(map(tuple, masks.read_masks(spark, f"{tmp_path}/masks").collect())) == plain(rows, 4, 0)
    assert 1 <= query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 3


def test_intervals_of_more_keys():
    x = [np.array(v) for v in ([1, 0, 1, 1], [5, 5, 5, 6], [0, 3, 4, 2], [4, 9, 8, 3])]
    assert [v.tolist() for v in masks.united(*x)] == [[0, 1, 1], [5, 5, 6], [3, 0, 2], [9, 8, 3]]

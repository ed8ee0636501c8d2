"""Exact blocks, the frequency cut by a budget, and low-complexity intervals, against plain versions."""

import random
from collections import Counter

import pytest

from overlace.operators import seeds, statistics


@pytest.mark.parametrize(("size", "longest"), [(50, 30), (7, 40), (1000, 9), (10**6, 5)])
def test_exact_blocks_equal_the_loop(spark, size, longest):
    rng = random.Random(size)
    ids = sorted(rng.sample(range(40_000), 400))
    reads = [(i, rng.choice([0, rng.randrange(longest)])) for i in ids]
    want, block, total = {}, 0, 0
    for i, n in reads:
        want[i] = block
        total += n
        if total >= size:
            block, total = block + 1, 0
    got = statistics.exact_blocks(spark.createDataFrame(reads, "rid long, rlen long").repartition(5), size)
    assert {r.rid: r.block for r in got.collect()} == want
    assert statistics.exact_blocks(spark.createDataFrame([], "rid long, rlen long"), size).count() == 0


def test_the_budget_cut(spark):
    rng = random.Random(3)
    counts = [(i, rng.choice([1, 2, 2, 3, 5, 9, 40])) for i in range(300)]
    df = spark.createDataFrame(counts, "code long, n long")
    pairs = lambda most: sum(n * (n - 1) // 2 for _, n in counts if n <= most)
    for budget in (0, 50, 500, 2000, 10**9):
        row = seeds.budget_cut(df, budget).first()
        assert row.pairs == pairs(row.most) <= budget and (row.next_pairs is None or row.next_pairs > budget) and (row.next_pairs is None) == (pairs(1000) <= budget)
    text = "".join(rng.choice("acgt") for _ in range(400)) + "acg" * 40
    seqs = spark.createDataFrame([(1, text), (2, text[100:])], "rid long, seq string")
    held = Counter(dict((r.code, r.n) for r in seeds.canonical_counts(seqs, 8).collect()))
    for budget in (300, 10_000):
        most = max((m for m in set(held.values()) if sum(n * (n - 1) // 2 for n in held.values() if n <= m) <= budget), default=0)
        assert seeds.seed_pairs_within(seqs, 8, budget).count() == seeds.seed_pairs(seqs, 8, most=most).count()


def plain_dust(text, window, threshold):
    score = {}
    for i in range(len(text)):
        for j in range(i + 4, min(len(text), i + window) + 1):
            c = Counter(text[x : x + 3] for x in range(i, j - 2))
            score[i, j] = sum(n * (n - 1) / 2 for n in c.values()) / (j - i - 3)
    found = set()
    for (i, j), s in score.items():
        if s > threshold and all(score[x, y] <= s for x in range(i, j - 3) for y in range(x + 4, j + 1)):
            found |= set(range(i, j))
    return found


@pytest.mark.parametrize("run", [1 << 20, 16])
def test_low_complexity_equals_an_exhaustive_search(spark, monkeypatch, run):
    monkeypatch.setattr(seeds, "RUN", run)
    rng = random.Random(run)
    texts = ["", "ac", "acg", "a" * 30, "acacacacacacac"]
    for _ in range(12):
        texts.append("".join(rng.choice([rng.choice("acgt") * rng.randrange(1, 12), rng.choice(["ac", "gat"]) * rng.randrange(1, 7), "".join(rng.choice("acgt") for _ in range(9))]) for _ in range(6))[:70])
    for text in texts:
        for threshold in (0.6, 2.0):
            got = {p for b, e in seeds.perfect_intervals(text.encode(), window=18, threshold=threshold) for p in range(b, e)}
            assert got == plain_dust(text, 18, threshold)
    got = seeds.dust_perfect(spark.createDataFrame([(1, texts[3]), (2, None), (3, "acgtt")], "rid long, seq string")).collect()
    assert [tuple(r) for r in got] == [(1, 0, 30)]


def test_next_starts_have_no_frame_that_is_summed_anew_for_every_row(spark):
    before = spark.range(10).selectExpr("id as rid", "id * 5000 as before")
    assert "unboundedfollowing" not in statistics.next_starts(before, 20_000)._jdf.queryExecution().executedPlan().toString().lower()

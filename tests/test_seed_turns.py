"""Bands and chains come from runs of seeds dealt by pair of reads; many pairs take turns, and shuffle files don't stay."""

import random
import time
from pathlib import Path

import pytest

from overlace.operators import seeds, storage, traces
from overlace.plans import registry

registry.load()
BANDS = ["aread", "bread", "comp", "panel", "band", "a1", "a2", "b1", "b2", "bases"]


@pytest.fixture(scope="module")
def reads(spark):
    rng = random.Random(3)
    base = "".join(rng.choice("acgt") for _ in range(900))
    turn = str.maketrans("acgt", "tgca")
    rows = []
    for i in range(14):
        text = list(base[rng.randrange(300) :])
        for _ in range(25):
            text[rng.randrange(len(text))] = rng.choice(["a", "c", "", "gt", "t"])
        text = "".join(text)
        rows.append((i, text.translate(turn)[::-1] if i % 3 == 0 else text))
    # One repeats a stretch, so that seeds lie over each other in A.
    return spark.createDataFrame([*rows, (14, base[:120] * 4 + base[:300]), (15, ""), (16, None)], "rid long, seq string")


@pytest.mark.parametrize("turns", [False, True])
def test_bands_of_runs(reads, turns, monkeypatch):
    if turns:
        monkeypatch.setattr(seeds, "AT_ONCE", 0)
        monkeypatch.setattr(seeds, "WIDE", 40)
    rule = {"width": 16, "panel": 200, "overlap": 60, "least": 18}
    expected = sorted(map(tuple, seeds.bands(seeds.seed_pairs(reads, 11, most=40), 11, **rule).select(*BANDS).collect()))
    made = seeds.bands_of(reads, 11, most=40, **rule)
    assert [c for c in made.columns] == BANDS and sorted(map(tuple, made.collect())) == expected and len(expected) > 100


@pytest.mark.parametrize("turns", [False, True])
def test_chains_of_runs(reads, turns, monkeypatch):
    if turns:
        monkeypatch.setattr(seeds, "AT_ONCE", 0)
        monkeypatch.setattr(seeds, "WIDE", 40)
    pairs = seeds.seed_pairs(reads, 11, most=40)
    plain = lambda df: sorted((*r[:7], tuple(map(tuple, r.anchors))) for r in df.collect())
    expected = plain(traces.chained(pairs, seeds.bands(pairs, 11), 11))
    assert plain(traces.chained_reads(reads, 11, most=40)) == expected and len(expected) > 20


@pytest.mark.parametrize("name", ["j4_symmetric_emit", "j5_diagonal_band_filter", "j7_redundancy_removal", "j6_chained_alignments"])
def test_seeds_are_no_rows(name, spark):
    plan = registry.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "explode(sequence" not in plan and plan.count("hashpartitioning(bucket") == 1


def test_redundant_ones_of_equals(spark):
    rows = [(2, 1, 0, 0, 50, 0, 50), (2, 1, 0, 0, 50, 0, 50), (2, 1, 0, 10, 50, 5, 40), (2, 1, 1, 10, 50, 5, 40), (2, 1, 0, 10, 60, 5, 40)]
    got = seeds.without_redundant(spark.createDataFrame(rows, "aread long, bread long, comp int, a1 long, a2 long, b1 long, b2 long"))
    assert sorted(map(tuple, got.collect())) == sorted([rows[0], *rows[3:]])


def test_shuffle_files_go_with_the_job(spark):
    top = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].getPath())
    files = lambda: set(top.rglob("shuffle_*.data"))
    before = files()
    made = storage.stored(spark.range(1000).repartition(3, "id"))
    until = time.time() + 10
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert not files() - before and made.count() == 1000
    assert spark.conf.get(storage.CLEANUP) == "false"

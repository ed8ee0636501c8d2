"""Walks along a read, weak runs and what breaks drop, against plain loops over the overlaps in order."""

import random

import pytest

from overlace.operators import coverage

SCHEMA = "ovl_id long, aread long, bread long, flags int, ab long, ae long, bb long, be long, alen long, blen long"


def made(rng, reads, most):
    rows = []
    for rid in range(reads):
        alen = rng.randrange(1500, 5000)
        for _ in range(rng.randrange(most)):
            ab = rng.choice([0, 0, 40, rng.randrange(alen - 300)])
            ae = min(alen, rng.choice([alen, ab + rng.randrange(150, 2500), ab + rng.randrange(150, 2500)]))
            bb = rng.randrange(2000)
            rows.append((len(rows), rid, rng.choice([rid, *range(100, 106)]), rng.choice([0, 0, 0, 1, 1, 2, 128]), ab, ae, bb, bb + ae - ab + rng.randrange(-20, 20), alen, 9000))
        if rng.random() < 0.6:  # a pair that nearly meets
            cut = rng.randrange(500, alen - 200)
            rows += [(len(rows), rid, 200, 0, 10, cut, 100, 90 + cut, alen, 9000), (len(rows) + 1, rid, 200, 0, cut + 30, alen, 120 + cut, 90 + alen, alen, 9000)]
    return rows


def by_read(rows):
    order = sorted(rows, key=lambda r: (r[1], r[2], r[3] & 1, r[4], r[5], r[6], r[7], r[0]))
    return {rid: [r for r in order if r[1] == rid] for rid in {r[1] for r in rows}}


def plain_walk(rows, tb, te, fewest, anchor):
    if len(rows) < fewest:
        return None, "overlaps"
    rows = [(r[4], r[5]) for r in rows if not r[3] & 2]
    if not rows or min(a for a, _ in rows) >= te:
        return None
    left, right = min(a for a, _ in rows), max(tb, max(e for _, e in rows))
    if sum(a == left for a, _ in rows) < fewest or sum(e == right for _, e in rows) < fewest:
        return None, "ends"
    at = far = max(e for a, e in rows if a == left)
    if at >= right:
        return None
    seen = 0
    for a, e in rows:
        if at == right:
            return None
        if a <= at - min(anchor, at - left) and e >= at + min(anchor, right - at):
            seen, far = seen + 1, max(far, e)
        if seen >= fewest:
            at, seen = far, 0
    return at, "gap"


@pytest.mark.parametrize(("fewest", "batch"), [(1, 10_000), (2, 3), (3, 7)])
def test_walks_equal_the_loop(spark, fewest, batch):
    rng = random.Random(fewest)
    reads = 200 * fewest
    rows = made(rng, reads, 14)
    trims = [(rid, rng.choice([0, 60]), rng.choice([900, 5000, 5000, 5000])) for rid in range(reads)]
    want = {rid: plain_walk(own, *trims[rid][1:], fewest, 80) for rid, own in by_read(rows).items()}
    held = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = coverage.walked_chimers(spark.createDataFrame(rows, SCHEMA).repartition(5), spark.createDataFrame(trims, "rid long, tb long, te long"), fewest=fewest, anchor=80)
        got = [(r.rid, r.pos, r.why) for r in got.collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)
    assert sorted(got, key=str) == sorted(((rid, *w) for rid, w in want.items() if w), key=str)
    assert sum(w is not None and w[1] == "gap" for w in want.values()) > 3 and (fewest > 1 or sum(w is None for w in want.values()) > 5)
    empty = spark.createDataFrame([], SCHEMA)
    assert coverage.walked_chimers(empty, spark.createDataFrame(trims, "rid long, tb long, te long")).count() == 0


def plain_drops(own, excluded, fuzz, width=100, clear=450):
    """Ids that the loop over breaks drops, and the breaks."""
    twins = set()
    for i, r in enumerate(own):
        for s in own[i + 1 :]:
            if r[2] == s[2] != r[1] and not (r[3] | s[3]) & 2 and min(r[5], s[5]) > max(r[4], s[4]):
                twins.add(r[0] if r[5] - r[4] < s[5] - s[4] else s[0])
    counted = [r for r in own if not r[3] & 2 and r[1] != r[2] and r[0] not in twins]
    if not counted:
        return set(), []
    bins = {}
    for r in counted:
        for b in range((r[4] + clear) // width, (r[5] - clear) // width):
            bins[b] = bins.get(b, 0) + 1
    alive, gone, found, beg = [r for r in own if not r[3] & 2], set(), [], None
    first, behind = (min(r[4] for r in counted) + clear) // width, (max(r[5] for r in counted) - clear) // width
    for b in range(first, behind + 1):
        low = b < behind and bins.get(b, 0) <= 1
        if low and beg is None:
            beg = b
        if beg is None or low:
            continue
        p1, p2, kept = (beg - 1) * width, (b + 1) * width, False
        if b < behind:
            kept = any(x < p1 and y > p2 for x, y in excluded)
            for i, r in enumerate(own):
                for s in own[i + 1 :] if fuzz else []:
                    if r[2] == s[2] and not {r[0], s[0]} & twins and not (r[3] | s[3]) & 128 and not (r[3] ^ s[3]) & 1 and abs(r[5] - s[4]) < fuzz and abs(r[7] - s[6]) < fuzz:
                        kept |= r[4] < p1 - clear and s[5] > p2 + clear
        found.append((own[0][1], p1, p2, b == behind, kept))
        beg = None
        if kept or not alive:
            continue
        longest = max(alive, key=lambda r: r[5] - r[4])
        out = [r for r in alive if (r[5] > p2 if longest[4] < p1 else r[4] < p1)]
        gone |= {r[0] for r in out}
        alive = [r for r in alive if r not in out]
    return gone, found


@pytest.mark.parametrize(("fuzz", "most"), [(0, 9), (60, 9), (400, 16)])
def test_drops_equal_the_loop(spark, fuzz, most):
    rng = random.Random(most + fuzz)
    rows = made(rng, 150, most)
    excluded = [(rng.randrange(150), b, b + rng.randrange(900, 3500)) for b in (rng.randrange(2000) for _ in range(300))]
    ovl, track = spark.createDataFrame(rows, SCHEMA).repartition(5), spark.createDataFrame(excluded, "rid long, beg long, fin long")
    runs = coverage.weak_runs(ovl, exclude=track, fuzz=fuzz)
    want = {rid: plain_drops(own, [x[1:] for x in excluded if x[0] == rid], fuzz) for rid, own in by_read(rows).items()}
    assert sorted(tuple(r) for r in runs.select("rid", "beg", "fin", "at_end", "kept").collect()) == sorted(x for _, found in want.values() for x in found)
    after = coverage.drop_at_breaks(ovl, runs)
    assert after.columns == ovl.columns and after.count() == len(rows)
    got = {r.ovl_id for r in after.where("(flags & 65536) != 0").collect()}
    assert got == set().union(*(gone for gone, _ in want.values())) and got
    assert any(x[4] for _, found in want.values() for x in found)
    assert coverage.drop_at_breaks(ovl.limit(0), coverage.weak_runs(ovl.limit(0), fuzz=fuzz)).count() == 0

"""Rules by brute force: k-mers, tiles and their consensus, patches, tours, files."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from overlace.operators import chains, contigs, graph, intervals, overlaps, seeds
from overlace.sources import sinks, text

TURN = str.maketrans("acgt", "tgca")


def turned(s):
    return s.translate(TURN)[::-1]


# k-mers


def test_seed_pairs_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(seeds, "RUN", 64)  # reads are cut to pieces
    rng = random.Random(1)
    base = "".join(rng.choice("acgt") for _ in range(300))
    reads = {1: base[:200], 2: base[50:260], 3: turned(base[100:300]), 4: "acgtacgtacgt" * 5, 5: base[:90] + "n" + base[90:150], 6: "", 7: None, 8: "acg"}
    df = spark.createDataFrame(list(reads.items()), "rid long, seq string")
    k, most = 8, 10
    spots = defaultdict(list)
    for r, s in reads.items():
        for comp, side in ((0, s or ""), (1, turned(s or "").replace("n", "n"))):
            for p in range(len(side) - k + 1):
                if set(side[p : p + k]) <= set("acgt"):
                    spots[side[p : p + k]].append((r, p, comp))
    for identity in (False, True):
        want = Counter()
        for places in spots.values():
            if len(places) <= most:
                for a, ap, ac in places:
                    for b, bp, bc in places:
                        if not ac and (b < a or (identity and a == b and (bp < ap or (bc and bp == ap)))):
                            want[a, b, ap, bp, bc] += 1
        got = Counter(tuple(r) for r in seeds.seed_pairs(df, k, most=most, identity=identity).select("aread", "bread", "apos", "bpos", "comp").collect())
        assert got == want
    counts = {r.kmer: r.n for r in seeds.kmer_counts(df, k, most=10**6).collect()}
    assert counts == {w: n for w, n in ((w, sum(not c for *_, c in p)) for w, p in spots.items()) if n}
    last, want = {}, set()
    for r, s in reads.items():
        for p in range(len(s or "") - k + 1):
            w = s[p : p + k]
            if set(w) <= set("acgt"):
                if (r, w) in last and p - last[r, w] <= 50:
                    want.add((r, p, p - last[r, w]))
                last[r, w] = p
    assert {tuple(r) for r in seeds.tandem_hits(df, k, farthest=50).collect()} == want


def test_panels_overlap(spark):
    pairs = spark.createDataFrame([(2, 1, 49_990, 100, 0), (2, 1, 50_010, 120, 0)], "aread long, bread long, apos long, bpos long, comp int")
    got = {(r.panel, r.a1, r.a2) for r in seeds.bands(pairs, 16, least=30).collect()}
    assert got == {(0, 49_990, 50_026)}


# tiles and consensus


def plain_align(pivot, other):
    n, m = len(pivot), len(other)
    d = [[i + j if not i or not j else 0 for j in range(m + 1)] for i in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            d[i][j] = min(d[i - 1][j - 1] + (pivot[i - 1] != other[j - 1]), d[i - 1][j] + 1, d[i][j - 1] + 1)
    stands, put, i, j = ["-"] * n, [""] * (n + 1), n, m
    while i or j:
        if i and j and d[i][j] == d[i - 1][j - 1] + (pivot[i - 1] != other[j - 1]):
            i, j = i - 1, j - 1
            stands[i] = other[j]
        elif i and d[i][j] == d[i - 1][j] + 1:
            i -= 1
        else:
            j -= 1
            put[i] = other[j] + put[i]
    return stands, put


def plain_consensus(tiles):
    pivot, out = tiles[0], ""
    lined = [plain_align(pivot, t) for t in tiles]
    for i in range(len(pivot) + 1):
        for s in range(contigs.SLOTS):
            found = Counter(p[i][s] for _, p in lined if len(p[i]) > s)
            if sum(found.values()) * 2 > len(tiles):
                out += min(found, key=lambda b: (-found[b], "acgt".index(b)))
        if i < len(pivot):
            found = Counter(x[i] for x, _ in lined)
            best = min(found, key=lambda b: (-found[b], "acgt-".index(b)))
            out += best.replace("-", "")
    return out


def noisy(rng, s, rate):
    out = ""
    for c in s:
        x = rng.random()
        out += "" if x < rate else c + rng.choice("acgt") if x < 2 * rate else rng.choice("acgt") if x < 3 * rate else c
    return out


def as_parts(rows):
    kind = pa.list_(pa.struct([("k", pa.int32()), ("piece", pa.int64()), ("text", pa.string()), ("lo", pa.int64()), ("hi", pa.int64()), ("comp", pa.bool_())]))
    lists = []
    for tiles in rows:
        entries = []
        for k, t in enumerate(tiles):
            comp = k % 3 == 2
            read = "g" * 37 + (turned(t) if comp else t)
            entries += [dict(k=k, piece=p, text=read[p * 100 : p * 100 + 100], lo=37, hi=37 + len(t), comp=comp) for p in range(0, (36 + len(t)) // 100 + 1)]
        lists.append(entries)
    return pa.array(lists, kind)


def test_tiles_and_consensus_equal_a_plain_version():
    rng = random.Random(3)
    rows = []
    for _ in range(12):
        truth = "".join(rng.choice("acgt") for _ in range(100))
        rows.append([noisy(rng, truth, 0.04) for _ in range(rng.randrange(1, 12))])
    parts = as_parts(rows)
    t = contigs.Tiles(parts)
    assert [t.text(i) for i in range(len(t.row))] == [x for r in rows for x in r if len(x) >= 20]
    assert contigs._consensus_of(parts) == [plain_consensus(r) for r in rows]


def test_consensus_finds_planted_indels(spark):
    """Reads that share a stretch: A has an inserted and a lost base, which the others outvote."""
    rng = random.Random(4)
    truth = "".join(rng.choice("acgt") for _ in range(300))
    a = truth[:150] + "a" + truth[150:230] + truth[231:]
    reads = {0: a} | {i: truth if i % 2 else turned(truth) for i in range(1, 7)}
    ovl, trace = [], []
    for i in range(1, 7):
        ovl.append((i, 0, i, 1 - i % 2, 0, len(a), 0, len(truth), 2, len(a), len(truth)))
        cut = [0, 100, 199, 300]  # where A's 100, 200 and 300 lie in B
        trace += [(i, 0, i, s, s * 100, min(s * 100 + 100, len(a)), 1, cut[s + 1] - cut[s]) for s in range(3)]
    o = spark.createDataFrame(ovl, "ovl_id long, aread long, bread long, flags int, ab long, ae long, bb long, be long, diffs long, alen long, blen long")
    t = spark.createDataFrame(trace, "ovl_id long, aread long, bread long, seg long, a_from long, a_to long, d long, blen long")
    s = spark.createDataFrame(list(reads.items()), "rid long, seq string")
    parts = contigs.tile_pieces(t, o, s)
    assert {(r.seg, r.text) for r in contigs.tile_texts(parts).where("k > 0").collect()} == {(0, truth[:100]), (1, truth[100:199]), (2, truth[199:300])}
    found = contigs.assembled(contigs.consensus(parts)).collect()
    assert [r.seq for r in found] == [truth]
    mapped = {(r.old_beg, r.new_beg, r.new_fin) for r in contigs.position_map(contigs.consensus(parts)).collect()}
    assert mapped == {(0, 0, 100), (100, 100, 199), (200, 199, 300)}
    votes = contigs.region(t, o, s, spark.createDataFrame([(0,)], "rid long"), first=1, last=2).collect()
    assert {(r.seg, r.col) for r in votes if r.base == "-"} == {(1, 50)} or any(r.base == "-" and r.seg == 1 for r in votes)
    assert all(r.of == 7 for r in votes) and len(votes) == 200


# patches


def test_patches_absorb_in_order(spark):
    rng = random.Random(5)
    rows = []
    for r in range(12):
        for _ in range(rng.randrange(1, 9)):
            beg = rng.randrange(0, 60) * 10
            for b in range(rng.randrange(1, 4)):
                rows.append((r, beg, beg + 30, b, 0, 100 * b, 100 * b + rng.choice([10, 20, 70])))
    df = spark.createDataFrame(rows, "aread long, beg long, fin long, bread long, comp int, b_beg long, b_fin long")
    want = set()
    for r in range(12):
        groups = defaultdict(list)
        for a, beg, fin, b, c, x, y in rows:
            if a == r:
                groups[beg, fin, (y - x) // 50].append((b, c, x, y))
        left = sorted(((-len(m), beg, fin, *min(m)) for (beg, fin, _), m in groups.items()))
        kept = []
        for n, beg, fin, b, c, x, y in left:
            over = next((k for k in kept if beg < k[1] and k[0] < fin), None)
            if over:
                over[2] -= n
            else:
                kept.append([beg, fin, -n, b, c, x, y])
        want |= {(r, *k) for k in kept}
    got = {tuple(x) for x in chains.merge_patches(df).select("aread", "beg", "fin", "support", "bread", "comp", "b_beg", "b_fin").collect()}
    assert got == want


# tours


def test_contained_reads_are_added_until_stable(spark):
    edge = spark.createDataFrame([(1, 2, "r", 5, 0), (2, 1, "l", 5, 0)], "src long, dst long, side string, ovh long, div long")
    spare = spark.createDataFrame([(2, 10 + 0, "r", 9, 0), (10, 11, "r", 8, 0), (11, 12, "r", 7, 0), (12, 13, "r", 6, 0), (2, 14, "r", 3, 0), (10, 2, "l", 9, 0), (11, 10, "l", 8, 0)], "src long, dst long, side string, ovh long, div long")
    kinds = spark.createDataFrame([(1, "proper"), (2, "proper")] + [(i, "contained") for i in range(10, 15)], "rid long, kind string")
    got = {(r.src, r.dst, r.optional) for r in graph.add_contained(edge, kinds, spare).collect()}
    assert {(2, 10, 1), (10, 11, 1), (11, 12, 1), (12, 13, 1)} <= got and (2, 14, 1) not in got
    assert {(r.src, r.dst) for r in graph.add_contained(edge, kinds, spare, rounds=1).collect()} == {(1, 2), (2, 1), (2, 10)}


def test_paths_join_end_to_end_until_stable(spark):
    paths = spark.createDataFrame([(1, 0, 1), (1, 1, 2), (3, 0, 3), (5, 0, 5), (5, 1, 6), (9, 0, 9)], "path long, pos long, rid long")
    edge = spark.createDataFrame([(2, 3, "r", 1, 0), (3, 5, "r", 1, 0), (6, 9, "r", 1, 0), (6, 1, "r", 1, 0)], "src long, dst long, side string, ovh long, div long")
    got = defaultdict(list)
    for r in sorted(graph.joined_paths(paths, edge).collect(), key=lambda r: r.pos):
        got[r.path].append(r.rid)
    # 6 leads to 1 and 9; once 1 lies on the same path, 9 is its only partner.
    assert sorted(got.values()) == [[1, 2, 3, 5, 6, 9]]
    chosen = spark.createDataFrame([(1, "l", 9), (2, "r", 3), (3, "l", 2), (5, "l", 5), (6, "r", 2)], "rid long, side string, next long")
    ends = {r.path: (r.end1, r.end2) for r in graph.end_labels(paths, chosen).collect()}
    assert ends == {1: (9, 3), 3: (1, -1), 5: (-1, 1), 9: (-1, -1)}


def test_best_next_looks_six_edges_ahead(spark):
    rng = random.Random(6)
    edges = {(a, rng.choice("lr"), b) for a in range(14) for b in rng.sample(range(14), 2) if a != b}
    df = spark.createDataFrame([(a, b, s) for a, s, b in edges], "src long, dst long, side string")
    want = {}
    for start in range(14):
        for side in "lr":
            n, way = Counter(), {}
            walks = [(b, b) for a, s, b in edges if a == start and s == side]
            for depth in range(1, 7):
                for first, at in walks:
                    n[at] += 1
                    way[at] = min(way.get(at, (depth, first)), (depth, first))
                walks = [(first, b) for first, at in walks for a, s, b in edges if a == at and s == side and b != start]
            if n:
                best = min(n, key=lambda v: (-n[v], v))
                want[start, side] = way[best][1]
    assert {(r.rid, r.side): r.next for r in graph.best_next(df).collect()} == want


@pytest.mark.parametrize("lookahead", [1, 2, 4, 7])
def test_walks_join_every_third_edge_only(lookahead, spark, monkeypatch):
    rng, tables, keep = random.Random(lookahead), [], graph.stored
    monkeypatch.setattr(graph, "stored", lambda df: tables.append(1) or keep(df))
    edges = {(a, rng.choice("lr"), b) for a in range(12) for b in rng.sample(range(12), 2)}
    df = spark.createDataFrame([(a, b, s) for a, s, b in edges], "src long, dst long, side string")
    want, leaving = {}, [(a, s) for a, s, _ in edges if a < 7]
    for start, side in leaving:
        n, way = Counter(), {}
        walks = [(b, b) for a, s, b in edges if a == start and s == side]
        for depth in range(1, lookahead + 1):
            for first, at in walks:
                n[at] += 1
                way[at] = min(way.get(at, (depth, first)), (depth, first))
            walks = [(first, b) for first, at in walks for a, s, b in edges if a == at and s == side and b != start]
        want[start, side] = way[min(n, key=lambda v: (-n[v], v))][1]
    got = graph.best_next(df, lookahead=lookahead, leaving=spark.createDataFrame(leaving, "rid long, side string").distinct()).collect()
    assert {(r.rid, r.side): r.next for r in got} == want
    assert len(tables) <= 3 + (lookahead - 1) // 3  # a table for every three edges, not for each


# intervals and order


def test_stab_counts_and_blocks(spark):
    rng = random.Random(7)
    spans = [(r, b, b + rng.randrange(-3, 20)) for r in range(5) for b in rng.choices(range(50), k=30)]
    points = [(r, p) for r in range(6) for p in rng.choices(range(70), k=20)]
    got = {(r.rid, r.pos): r.n for r in intervals.stab_counts(spark.createDataFrame(points, "rid long, pos long"), spark.createDataFrame(spans, "rid long, beg long, fin long"), ["rid"]).collect()}
    assert got == {(r, p): sum(s == r and b <= p <= f for s, b, f in spans) for r, p in points}
    one, two = spark.createDataFrame([(1, 5), (2, 6)], "rid long, beg long"), spark.createDataFrame([(3, 5)], "rid long, beg long")
    assert intervals.concat_blocks([one, two]).count() == 3
    with pytest.raises(ValueError, match="two blocks: 1"):
        intervals.concat_blocks([one, one.where("rid = 1")])


# files


def test_sequences_and_tracks_survive_a_round_trip(spark, tmp_path):
    seqs = spark.createDataFrame([("r1 a=1", "acgt" * 60), ("r2 RQ=7 a>b", "ttt")], "name string, seq string")
    seqs.select(F.concat(F.lit(">"), F.col("name"), F.lit("\n"), F.col("seq")).alias("value")).coalesce(1).write.text(f"{tmp_path}/fasta")
    back = {r[0]: r[1] for r in text.read_fasta(spark, f"{tmp_path}/fasta", shortest=0).select("header", "seq").collect()}
    assert back == {"r1 a=1": "acgt" * 60, "r2 RQ=7 a>b": "ttt"}
    assert [r.name for r in text.read_fasta(spark, f"{tmp_path}/fasta", shortest=10).collect()] == ["r1"]
    reads = spark.createDataFrame([(4, "acgt" * 50)], "rid long, seq string")
    track = spark.createDataFrame([(4, "dust", 5, 9), (4, "dust", 1, 2)], "rid long, track string, beg long, fin long")
    sinks.fasta_lines(reads, track).select("value").coalesce(1).write.text(f"{tmp_path}/out")
    row = text.read_fasta(spark, f"{tmp_path}/out", shortest=0).first()
    assert (row.name, row.header, row.seq) == ("read_4", "read_4 dust=1,2,5,9", "acgt" * 50)
    spark.createDataFrame([("7 10 20",), ("8 5 9",)], "value string").coalesce(1).write.text(f"{tmp_path}/track")
    assert {tuple(r) for r in text.read_track(spark, f"{tmp_path}/track").collect()} == {(7, 10, 20), (8, 5, 9)}
    more = spark.createDataFrame([(1, "a", 5, 9), (1, "a", 1, 2), (2, "b", 0, 3)], "rid long, track string, beg long, fin long")
    sinks.write_track(more, f"{tmp_path}/tracks")
    assert {tuple(r) for r in spark.read.parquet(f"{tmp_path}/tracks").select("rid", "track", "beg", "fin").collect()} == {(1, "a", 5, 9), (1, "a", 1, 2), (2, "b", 0, 3)}
    assert [r.beg for r in spark.read.parquet(f"{tmp_path}/tracks/track=a").collect()] == [1, 5]


def test_alignments_and_graphs_survive_a_round_trip(spark, tmp_path):
    sam = ["@HD\tVN:1.6", "@SQ\tSN:c1\tLN:9", "q1\t16\tc1\t7\t60\t5M\t*\t0\t0\tacgta\t!!!\"!\tNM:i:0", "q2\t4\t*\t0\t0\t*\t*\t0\t0\tac\t!!"]
    spark.createDataFrame([(x,) for x in sam], "value string").coalesce(1).write.text(f"{tmp_path}/sam")
    got = [(r.qname, r.flag, r.rname, r.pos, r.mapq, r.cigar, r.seq) for r in text.read_sam(spark, f"{tmp_path}/sam").collect()]
    assert got == [("q1", 16, "c1", 7, 60, "5M", "acgta"), ("q2", 4, "*", 0, 0, "*", "ac")]
    edge = spark.createDataFrame([(1, 2, "r", 30, 4)], "src long, dst long, side string, ovh long, div long")
    sinks.graph_lines(edge).coalesce(1).write.text(f"{tmp_path}/graph")
    assert [tuple(r) for r in text.tgf_edges(spark.read.text(f"{tmp_path}/graph")).collect()] == [(1, 2, "r:30:4")]
    paths = spark.createDataFrame([(1, 0, 5), (1, 1, 6), (1, 2, 7), (2, 0, 9)], "path long, pos long, rid long")
    sinks.path_lines(paths).select("value").coalesce(1).write.text(f"{tmp_path}/paths")
    got = {(r.path, r.pos, r.src, r.dst) for r in text.path_lines(spark.read.text(f"{tmp_path}/paths")).collect()}
    assert got == {(1, 0, 5, 6), (1, 1, 6, 7)}
    sinks.bed_lines(spark.createDataFrame([(3, 1, 4, "tan")], "rid long, beg long, fin long, track string")).coalesce(1).write.text(f"{tmp_path}/bed")
    assert [r[0] for r in spark.read.text(f"{tmp_path}/bed").collect()] == ["read_3\t1\t4\ttan"]

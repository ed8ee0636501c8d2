"""Queries of chaining, stitching, repair, consensus and contig analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from overlace.operators import chains as H
from overlace.operators import contigs as G
from overlace.operators import coverage as C
from overlace.operators import overlaps as O  # noqa: E741
from overlace.operators.storage import stored
from overlace.plans.intervals import REPEATS, merged
from overlace.plans.overlaps import PROJECT, TRIMMED, trim
from overlace.plans.registry import query


@query("c1_chain_overlaps")
def _(v):
    return H.chain(v("f_ovl"))


@query("c1_unique_chains")
def _(v):
    """Chains that grow from overlaps with unique bases, by the repeat track."""
    ovl = v("f_ovl")
    return H.chain(ovl, unique=H.unique_bases(ovl, v("f_track").where("track = 'repeats'").select("rid", "beg", "fin")), least=500)


def _table(v):
    return H.chain_table(v("f_ovl"), H.chain(v("f_ovl")))


@query("c2_keep_chains")
def _(v):
    return H.keep_chains(_table(v)).select("aread", "bread", "chain", "ab", "ae", "bases", "n")


@query("c6_separate_pairs")
def _(v):
    return H.separate_pairs(_table(v))


STITCH = """k AS (SELECT *, flags & 1 AS comp FROM {f_ovl} WHERE (flags & 2) = 0), l AS (SELECT *, ab - LAG(ae) OVER w AS da, bb - LAG(be) OVER w AS db FROM k WINDOW w AS (PARTITION BY aread, bread, comp ORDER BY ab, ae, bb, be, ovl_id)),
n AS (SELECT *, SUM(CASE WHEN COALESCE(ABS(da) < FUZZ AND ABS(db) < FUZZ AND ABS(da - db) < DIFFER, FALSE) THEN 0 ELSE 1 END) OVER (PARTITION BY aread, bread, comp ORDER BY ab, ae, bb, be, ovl_id ROWS UNBOUNDED PRECEDING) AS run FROM l),
sg AS (SELECT aread, bread, comp, run, arg_min(ovl_id, (ab, ae, bb, be, ovl_id)) AS ovl_id, MIN(ab) AS ab, MAX(ae) AS ae, MIN(bb) AS bb, MAX(be) AS be, CAST(SUM(diffs) AS BIGINT) AS diffs, COUNT(*) AS n FROM n GROUP BY 1, 2, 3, 4)"""


@query("c4_stitch_fuzz", STITCH.replace("FUZZ", "2000").replace("DIFFER", "1500") + " SELECT aread, bread, CAST(comp AS INT) AS comp, ovl_id, ab, ae, bb, be, diffs, n FROM sg")
def _(v):
    return H.stitch(v("f_ovl"), fuzz=2000, differ=1500)


@query("c4_longest_partner")
def _(v):
    return H.stitch_fuzz(v("f_ovl"), fuzz=2000, differ=1500)


@query("c3_stitch_real_chains")
def _(v):
    """The chains of C1 merged where their gaps are small or of low complexity."""
    low = v("f_track").where("track in ('dust', 'tan')").select("rid", "beg", "fin")
    return H.stitch_chains(v("f_ovl"), stored(H.chain(v("f_ovl"))), low, gap=1000, low_gap=4000, anchor=300, most=20)


@query("c3_stitch_chain", STITCH.replace("FUZZ", "3000").replace("DIFFER", "3000") + " SELECT ovl_id, ab, ae, n FROM sg WHERE n > 1")
def _(v):
    return H.stitch(v("f_ovl"), fuzz=3000, differ=3000).where("n > 1").select("ovl_id", "ab", "ae", "n")


@query("c5_stitch_trace", STITCH.replace("FUZZ", "2000").replace("DIFFER", "2000") + ", m AS (SELECT n.ovl_id AS old, s.ovl_id AS new FROM n JOIN sg s ON s.aread = n.aread AND s.bread = n.bread AND s.comp = n.comp AND s.run = n.run WHERE s.n > 1) SELECT new AS ovl_id, seg, CAST(SUM(d) AS BIGINT) AS d, CAST(SUM(blen) AS BIGINT) AS blen FROM {f_trace} t JOIN m ON m.old = t.ovl_id GROUP BY 1, 2")
def _(v):
    """The traces of stitched overlaps under one id: segments that two of them share are added."""
    s = H.stitch(v("f_ovl"), fuzz=2000, differ=2000).where("n > 1").select("aread", "bread", "comp", F.col("ovl_id").alias("new"), F.col("ab").alias("lo"), F.col("ae").alias("hi"))
    o = v("f_ovl").where(~O.discarded()).withColumn("comp", O.comp().cast("int")).select("ovl_id", "aread", "bread", "comp", "ab", "ae")
    m = o.join(s, ["aread", "bread", "comp"]).where("ab >= lo and ae <= hi").select("ovl_id", "new")
    return v("f_trace").join(m, "ovl_id").groupBy(F.col("new").alias("ovl_id"), "seg").agg(F.sum("d").alias("d"), F.sum("blen").alias("blen"))


@query("c7_missed_adapter_trim", """s AS (SELECT aread AS rid, alen, CAST(FLOOR((GREATEST(ab, alen - be) + LEAST(ae, alen - bb)) / 2) AS BIGINT) AS point FROM {f_ovl} WHERE aread = bread AND (flags & 1) = 1 AND LEAST(ae, alen - bb) > GREATEST(ab, alen - be)),
p AS (SELECT DISTINCT rid, alen, point FROM s), n AS (SELECT p.rid, p.point, COUNT(o.ovl_id) AS n FROM p LEFT JOIN {f_ovl} o ON o.aread = p.rid AND o.aread <> o.bread AND (o.flags & 2) = 0 AND o.ab <= point - 400 AND o.ae >= point + 400 GROUP BY 1, 2)
SELECT p.rid, p.point, CASE WHEN p.point >= alen - p.point THEN 0 ELSE p.point END AS beg, CASE WHEN p.point >= alen - p.point THEN p.point ELSE alen END AS fin FROM p JOIN n ON n.rid = p.rid AND n.point = p.point WHERE n.n <= 8""")
def _(v):
    return H.hairpins(v("f_ovl"), spanners=8)


@query("c8_chimer_trim")
def _(v):
    return H.longest_part(C.walls(v("f_ovl"), at_least=2), v("f_reads"))


GAPS = """k AS (SELECT *, flags & 1 AS comp FROM {f_ovl} WHERE (flags & 2) = 0 AND aread <> bread), g AS (SELECT aread, bread, comp, LAG(ae) OVER w AS beg, ab AS fin, LAG(be) OVER w AS b_beg, bb AS b_fin FROM k WINDOW w AS (PARTITION BY aread, bread, comp ORDER BY ab, ae, bb, be, ovl_id)),
gp AS (SELECT * FROM g WHERE fin > beg AND b_fin >= b_beg AND fin - beg <= 2000 AND (SELECT COUNT(*) FROM k WHERE k.aread = g.aread AND k.ab <= g.beg - 400 AND k.ae >= g.fin + 400) <= 4)"""


@query("c9_gap_patches", f"{GAPS} SELECT aread, beg, fin, bread, CAST(comp AS INT) AS comp, b_beg, b_fin FROM gp")
def _(v):
    return H.gap_patches(v("f_ovl"), spanners=4)


def _patches(v):
    return H.merge_patches(H.gap_patches(v("f_ovl"), spanners=4))


@query("c10_merge_patches")
def _(v):
    return _patches(v)


@query("c10_distinct_patches", f"{GAPS}, o AS (SELECT aread, beg, fin, FLOOR((b_fin - b_beg) / 50) AS size, COUNT(*) AS support FROM gp GROUP BY 1, 2, 3, 4) SELECT aread, COUNT(*) AS patches, CAST(SUM(support) AS BIGINT) AS support FROM o GROUP BY 1")
def _(v):
    """What merging has to keep: the support of a read's patches, however they absorb each other."""
    one = H.gap_patches(v("f_ovl"), spanners=4).groupBy("aread", "beg", "fin", F.floor((F.col("b_fin") - F.col("b_beg")) / 50).alias("size")).agg(F.count("*").alias("support"))
    kept = _patches(v).groupBy("aread").agg(F.sum("support").alias("support"))
    return one.groupBy("aread").agg(F.count("*").alias("patches")).join(kept, "aread").select("aread", "patches", "support")


C11 = """b0 AS (SELECT t.aread, t.bread, t.seg, t.ovl_id, t.blen, t.a_to - t.a_from AS size, o.flags & 1 AS c, o.blen AS b_size, o.bb + SUM(t.blen) OVER (PARTITION BY t.ovl_id ORDER BY t.seg ROWS UNBOUNDED PRECEDING) AS hi FROM {f_trace} t JOIN {f_ovl} o ON o.ovl_id = t.ovl_id),
b1 AS (SELECT b0.*, hi - blen AS lo FROM b0 JOIN {f_q} q ON q.rid = aread AND q.seg = b0.seg WHERE (q = 0 OR q >= 30) AND size = 100 AND aread <> bread AND blen > 0),
b2 AS (SELECT aread, seg, ovl_id, bread, UNNEST(RANGE(CAST(FLOOR((CASE WHEN c = 1 THEN b_size - hi ELSE lo END) / 100) AS BIGINT), CAST(FLOOR((CASE WHEN c = 1 THEN b_size - lo ELSE hi END - 1) / 100) AS BIGINT) + 1)) AS b_seg FROM b1),
me AS (SELECT b2.aread, b2.seg, ovl_id, AVG(q) AS quality FROM b2 JOIN {f_q} q ON q.rid = bread AND q.seg = b_seg GROUP BY 1, 2, 3), w AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY aread, seg ORDER BY quality, ovl_id) AS k FROM me)"""


@query("c11_segment_patches", f"{C11} SELECT aread AS rid, seg, ovl_id, quality FROM w WHERE k = 1")
def _(v):
    return H.segment_patches(v("f_trace"), v("f_ovl"), v("f_q"))


@query("c11_outside_patches", f"{GAPS}, {C11}, tk AS (SELECT DISTINCT aread, UNNEST(RANGE(CAST(FLOOR(beg / 100) AS BIGINT), CAST(FLOOR((fin - 1) / 100) AS BIGINT) + 1)) AS seg FROM gp) SELECT aread AS rid, seg, ovl_id, quality FROM w WHERE k = 1 AND NOT EXISTS (SELECT 1 FROM tk WHERE tk.aread = w.aread AND tk.seg = w.seg)")
def _(v):
    return H.segment_patches(v("f_trace"), v("f_ovl"), v("f_q"), patches=H.gap_patches(v("f_ovl"), spanners=4))


#: Patches that overlap no other one of their read: what SQL can say without absorption.
ALONE = f"""{GAPS}, o AS (SELECT aread, beg, fin, FLOOR((b_fin - b_beg) / 50) AS size, MIN(ROW(bread, comp, b_beg, b_fin)) AS b FROM gp GROUP BY 1, 2, 3, 4), p0 AS (SELECT aread, beg, fin, b[1] AS bread, b[2] AS comp, b[3] AS b_beg, b[4] AS b_fin FROM o),
p1 AS (SELECT * FROM p0 x WHERE NOT EXISTS (SELECT 1 FROM p0 y WHERE y.aread = x.aread AND x.beg < y.fin AND y.beg < x.fin AND (x.beg, x.fin, x.bread, x.b_beg) <> (y.beg, y.fin, y.bread, y.b_beg))),
pt AS (SELECT aread AS rid, beg, fin, substring(CASE WHEN comp = 1 THEN reverse(translate(seq, 'acgt', 'tgca')) ELSE seq END, b_beg + 1, b_fin - b_beg) AS text FROM p1 JOIN {{f_seq}} s ON s.rid = bread)"""


def _alone(v):
    from overlace.operators import intervals as I  # noqa: E741

    size = F.floor((F.col("b_fin") - F.col("b_beg")) / 50)
    p = H.gap_patches(v("f_ovl"), spanners=4).groupBy("aread", "beg", "fin", size.alias("size")).agg(F.min(F.struct("bread", "comp", "b_beg", "b_fin")).alias("b")).select("aread", "beg", "fin", "b.*")
    key = ["aread", "beg", "fin", "bread", "b_beg"]
    met = I.interval_join(p.select(*key), p.select("aread", F.col("beg"), F.col("fin"), F.col("bread").alias("o_bread"), F.col("b_beg").alias("o_b_beg")), "aread")
    other = (F.col("beg") != F.col("o_beg")) | (F.col("fin") != F.col("o_fin")) | (F.col("bread") != F.col("o_bread")) | (F.col("b_beg") != F.col("o_b_beg"))
    return H.patch_texts(p.join(met.where(other).select(*key).distinct(), key, "left_anti"), v("f_seq"))


@query("c12_apply_patches", f"""{ALONE}, pz AS (SELECT p.rid, beg, fin, COALESCE(LAG(fin) OVER (PARTITION BY p.rid ORDER BY beg), 0) AS fr, text, seq FROM pt p JOIN {{f_seq}} s ON s.rid = p.rid), wh AS (SELECT rid, string_agg(substring(seq, fr + 1, GREATEST(0, beg - fr)) || text, '' ORDER BY beg) AS body, MAX(fin) AS last FROM pz GROUP BY 1),
ou AS (SELECT s.rid, CASE WHEN w.rid IS NULL THEN seq ELSE body || substring(seq, last + 1) END AS seq FROM {{f_seq}} s LEFT JOIN wh w ON w.rid = s.rid) SELECT rid, seq, rid AS source FROM ou WHERE length(seq) >= 500""")
def _(v):
    return H.apply_patches(v("f_seq"), _alone(v), shortest=500)


@query("c12_apply_merged_patches")
def _(v):
    """C9 to C12: every patch that merging keeps, overlapping ones too, put into the reads."""
    return H.apply_patches(v("f_seq"), stored(H.patch_texts(_patches(v), v("f_seq"))), shortest=500)


@query("c12_converted_intervals", f"""{ALONE}, tr AS (SELECT ROW_NUMBER() OVER () AS k, rid, track, beg, fin FROM {{f_track}}), e AS (SELECT k, rid, track, beg AS x, 0 AS which FROM tr UNION ALL SELECT k, rid, track, fin, 1 FROM tr),
m AS (SELECT e.k, e.rid, track, which, COALESCE(MIN(CASE WHEN p.beg < x AND x < p.fin THEN p.beg END), x) + COALESCE(SUM(CASE WHEN p.fin <= x THEN length(text) - (p.fin - p.beg) END), 0) AS y FROM e LEFT JOIN pt p ON p.rid = e.rid GROUP BY e.k, e.rid, track, which, x)
SELECT a.rid, a.track, CAST(a.y AS BIGINT) AS beg, CAST(b.y AS BIGINT) AS fin FROM m a JOIN m b ON a.k = b.k AND a.which = 0 AND b.which = 1 WHERE b.y > a.y""")
def _(v):
    return H.converted_intervals(v("f_track"), _alone(v))


@query("i4_homogenize", f"{PROJECT}, h AS (SELECT p.bread AS rid, CASE WHEN (flags & 1) = 1 THEN blen - (bb + q) ELSE bb + p END AS beg, CASE WHEN (flags & 1) = 1 THEN blen - (bb + p) ELSE bb + q END AS fin FROM p JOIN {{f_ovl}} o ON o.ovl_id = p.ovl_id WHERE q - p >= 500), {merged('h')} SELECT rid, CAST(beg AS BIGINT) AS beg, CAST(fin AS BIGINT) AS fin FROM mg")
def _(v):
    p = O.project(v("f_ovl"), v("f_trace"), v("f_track").where("track = 'repeats'").select("rid", "beg", "fin"))
    return H.homogenize(p, v("f_ovl"))


@query("i9_repeat_modules", f"""{TRIMMED}, ns AS (SELECT * FROM tr WHERE aread <> bread), ex AS (SELECT aread AS rid FROM ns WHERE (flags & 2) = 0 GROUP BY 1 HAVING (COUNT(*) FILTER (ab <= ta_b) > 0) <> (COUNT(*) FILTER (ae >= ta_e) > 0)),
bn AS (SELECT rid, bin, COUNT(*) AS n FROM (SELECT aread AS rid, UNNEST(RANGE(CAST(FLOOR((ab + 599) / 100) AS BIGINT), CAST(FLOOR((ae - 500) / 100) AS BIGINT))) AS bin FROM ns) GROUP BY 1, 2),
rp AS (SELECT rid, beg, fin FROM {{f_track}} WHERE track = 'repeats'), {merged('rp')}, i AS (SELECT b.rid, mg.beg, bin, bin - ROW_NUMBER() OVER (PARTITION BY b.rid, mg.beg ORDER BY bin) AS g FROM bn b JOIN mg ON mg.rid = b.rid AND bin * 100 >= mg.beg AND bin * 100 + 100 <= mg.fin WHERE b.n < 6 AND b.rid IN (SELECT rid FROM ex)),
r AS (SELECT rid, MIN(bin) AS a, MAX(bin) AS b FROM i GROUP BY rid, beg, g HAVING MAX(bin) - MIN(bin) + 1 > 7) SELECT rid, CAST(FLOOR((a + b + 1) / 2) AS BIGINT) * 100 AS beg, CAST(FLOOR((a + b + 1) / 2) AS BIGINT) * 100 + 100 AS fin FROM r""")
def _(v):
    return H.repeat_modules(v("f_ovl"), trim(v), v("f_track").where("track = 'repeats'").select("rid", "beg", "fin"), low=6)


@query("r1_tiles", "SELECT aread, seg, CAST(k AS INT) AS k, ovl_id, bread, d FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY aread, seg ORDER BY d, ovl_id) AS k FROM {f_trace} WHERE aread <> bread) t WHERE k <= 39")
def _(v):
    return G.tiles(v("f_trace"))


@query("r2_tile_rank", """t AS (SELECT t.*, bb + SUM(t.blen) OVER (PARTITION BY t.ovl_id ORDER BY seg ROWS UNBOUNDED PRECEDING) - FLOOR(t.blen / 2) AS mid FROM {f_trace} t JOIN {f_ovl} o ON o.ovl_id = t.ovl_id WHERE t.aread <> t.bread),
j AS (SELECT t.aread, t.seg, t.ovl_id, q FROM t LEFT JOIN {f_q} q ON q.rid = t.bread AND q.seg = CAST(FLOOR(mid / 100) AS BIGINT)) SELECT aread, seg, ovl_id, ROW_NUMBER() OVER (PARTITION BY aread, seg ORDER BY COALESCE(q, 1073741824), ovl_id) AS rank FROM j""")
def _(v):
    return G.tile_rank(v("f_trace"), v("f_ovl"), v("f_q"))


TEXTS = """fl AS (SELECT *, SUM(blen) OVER (PARTITION BY ovl_id ORDER BY seg ROWS UNBOUNDED PRECEDING) AS aft, ROW_NUMBER() OVER (PARTITION BY aread, seg ORDER BY d, ovl_id) AS k FROM {f_trace} WHERE aread <> bread AND a_to - a_from = 100),
bt AS (SELECT fl.aread, fl.seg, k, substring(CASE WHEN (flags & 1) = 1 THEN reverse(translate(seq, 'acgt', 'tgca')) ELSE seq END, CAST(bb + aft - fl.blen + 1 AS BIGINT), fl.blen) AS text FROM fl JOIN {f_ovl} o ON o.ovl_id = fl.ovl_id JOIN {f_seq} s ON s.rid = fl.bread WHERE k <= 19),
at_ AS (SELECT aread, seg, 0 AS k, substring(seq, seg * 100 + 1, 100) AS text FROM (SELECT DISTINCT aread, seg FROM fl WHERE k <= 19) x JOIN {f_seq} s ON s.rid = aread), tx AS (SELECT * FROM (SELECT * FROM bt UNION ALL SELECT * FROM at_) u WHERE length(text) >= 20)"""


def _consensus(v):
    return G.consensus(G.tile_pieces(v("f_trace"), v("f_ovl"), v("f_seq")))


@query("r3_grown_consensus")
def _(v):
    """Consensus by a profile that grows: insertions of any length, tiles of any length."""
    return G.grown_consensus(G.tile_pieces(v("f_trace"), v("f_ovl"), v("f_seq")))


@query("r3_tile_texts", f"{TEXTS} SELECT aread, seg, CAST(k AS INT) AS k, text FROM tx")
def _(v):
    """What the consensus is made of: the A tile and its B tiles, cut from pieces."""
    return G.tile_texts(G.tile_pieces(v("f_trace"), v("f_ovl"), v("f_seq")))


@query("r3_tile_consensus")
def _(v):
    return _consensus(v)


@query("r4_assemble_corrected")
def _(v):
    return G.assembled(_consensus(v))


@query("r5_position_map")
def _(v):
    return G.position_map(_consensus(v))


@query("r6_convert_overlaps")
def _(v):
    return G.convert(v("f_ovl"), stored(G.position_map(_consensus(v))))


@query("r7_region_msa")
def _(v):
    return G.region(v("f_trace"), v("f_ovl"), v("f_seq"), v("f_reads").where("best = 1"), first=5, last=7)


@query("r8_contig_overlap_chain", """k AS (SELECT *, flags & 1 AS c FROM {f_ovl} WHERE (flags & 2) = 0 AND aread <> bread), s AS (SELECT *, COALESCE(c = LAG(c) OVER w AND bb >= LAG(bb) OVER w AND ABS(ab - LAG(ae) OVER w) <= 1500 AND ABS(bb - LAG(be) OVER w) <= 1500, TRUE) AS ok FROM k WINDOW w AS (PARTITION BY aread, bread ORDER BY ab, ae, bb, be, ovl_id)),
g AS (SELECT aread, bread, MIN(ab) AS ab, MAX(ae) AS ae, MIN(bb) AS bb, MAX(be) AS be, MAX(alen) AS alen, MAX(blen) AS blen FROM s GROUP BY 1, 2 HAVING BOOL_AND(ok))
SELECT aread, bread, CASE WHEN (ab <= 1500 AND alen - ae <= 1500) OR (bb <= 1500 AND blen - be <= 1500) THEN 'contained' WHEN (ab <= 1500 AND blen - be <= 1500) OR (bb <= 1500 AND alen - ae <= 1500) THEN 'bridge' ELSE 'inner' END AS kind FROM g""")
def _(v):
    return G.contig_chains(v("f_ovl"), fuzz=1500)


def _contig_reads(v):
    """Wells stand for contigs: their reads in id order, each with two thirds of its length."""
    from pyspark.sql import Window as W

    w = W.partitionBy("well").orderBy("rid")
    return v("f_reads").select(F.col("well").alias("contig"), F.row_number().over(w).cast("long").alias("pos"), "rid", F.floor(F.col("rlen") * 2 / 3).cast("long").alias("len"))


CONTIGS = "cr AS (SELECT well AS contig, ROW_NUMBER() OVER (PARTITION BY well ORDER BY rid) AS pos, rid, CAST(FLOOR(rlen * 2 / 3) AS BIGINT) AS len FROM {f_reads}), pl AS (SELECT contig, pos, rid, len, CAST(SUM(len) OVER (PARTITION BY contig ORDER BY pos ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fin FROM cr)"


@query("r9_map_reads_to_contigs", f"{CONTIGS} SELECT contig, pos, rid, fin - len AS beg, fin FROM pl")
def _(v):
    return G.reads_on_contigs(_contig_reads(v))


@query("a17_contig_coverage", f"{CONTIGS}, x AS (SELECT contig, fin - len + ab AS x, LEAST(fin - len + ae, fin) AS y FROM pl JOIN {{f_ovl}} o ON o.aread = pl.rid WHERE (flags & 2) = 0 AND aread <> bread), b AS (SELECT *, UNNEST(RANGE(CAST(FLOOR(x / 500) AS BIGINT), CAST(FLOOR((y - 1) / 500) AS BIGINT) + 1)) AS bin FROM x WHERE y > x), c AS (SELECT contig, bin, CAST(FLOOR(SUM(LEAST(y, (bin + 1) * 500) - GREATEST(x, bin * 500)) / 500) AS BIGINT) AS cov FROM b GROUP BY 1, 2) SELECT contig, bin, cov, cov < 3 AS low FROM c")
def _(v):
    return G.contig_coverage(G.reads_on_contigs(_contig_reads(v)), v("f_ovl"))


@query("a18_contig_read_sharing", "c AS (SELECT DISTINCT CAST(FLOOR(aread / 10) AS BIGINT) AS contig, bread AS rid FROM {f_ovl}) SELECT x.contig AS c1, y.contig AS c2, COUNT(*) AS shared FROM c x JOIN c y ON x.rid = y.rid AND x.contig < y.contig GROUP BY 1, 2")
def _(v):
    return G.shared_reads(v("f_ovl").select(F.floor(F.col("aread") / 10).cast("long").alias("contig"), F.col("bread").alias("rid")))


R8 = """k AS (SELECT *, flags & 1 AS c FROM {f_ovl} WHERE (flags & 2) = 0 AND aread <> bread), s AS (SELECT *, COALESCE(c = LAG(c) OVER w AND bb >= LAG(bb) OVER w AND ABS(ab - LAG(ae) OVER w) <= 1500 AND ABS(bb - LAG(be) OVER w) <= 1500, TRUE) AS ok FROM k WINDOW w AS (PARTITION BY aread, bread ORDER BY ab, ae, bb, be, ovl_id)),
g AS (SELECT aread, bread, MIN(ab) AS ab, MAX(ae) AS ae, MIN(bb) AS bb, MAX(be) AS be, MAX(alen) AS alen, MAX(blen) AS blen FROM s GROUP BY 1, 2 HAVING BOOL_AND(ok)),
rl AS (SELECT aread, bread, CASE WHEN (ab <= 1500 AND alen - ae <= 1500) OR (bb <= 1500 AND blen - be <= 1500) THEN 'contained' WHEN (ab <= 1500 AND blen - be <= 1500) OR (bb <= 1500 AND alen - ae <= 1500) THEN 'bridge' ELSE 'inner' END AS kind FROM g)"""
R10 = f"""{R8}, rx AS (SELECT aread AS contig, COUNT(*) AS n, COUNT(*) FILTER (kind = 'contained') AS i FROM rl WHERE kind <> 'inner' GROUP BY 1), rd AS (SELECT aread AS contig, COUNT(DISTINCT bread) AS reads FROM k GROUP BY 1),
rp AS (SELECT rid, beg, fin FROM {{f_track}} WHERE track = 'repeats'), {merged('rp')}, rc AS (SELECT rid AS contig, SUM(fin - beg) AS rep FROM mg GROUP BY 1),
ct AS (SELECT r.rid AS contig, rlen AS len, COALESCE(reads, 0) AS reads, CAST(FLOOR(COALESCE(rep, 0) * 100 / rlen) AS BIGINT) AS repeat FROM {{f_reads}} r LEFT JOIN rd ON rd.contig = r.rid LEFT JOIN rc ON rc.contig = r.rid),
cl AS (SELECT ct.contig, len, CASE WHEN n IS NULL THEN CASE WHEN (reads > 20 AND repeat <= 10) OR len > 12000 THEN 'primary' ELSE 'discard' END WHEN i > 0 THEN 'alternative' ELSE 'primary' END AS kind FROM ct LEFT JOIN rx ON rx.contig = ct.contig)"""


def _classified(v, ovl=None, repeats=None):
    """Contigs with their length and kind, from chains of overlaps, partners and repeat share."""
    from overlace.operators import intervals as I  # noqa: E741

    ovl = v("f_ovl") if ovl is None else ovl
    repeats = v("f_track").where("track = 'repeats'").select("rid", "beg", "fin") if repeats is None else repeats
    relations = G.contig_chains(ovl, fuzz=1500).where("kind != 'inner'").select(F.col("aread").alias("contig"), "kind")
    partners = O.purge(ovl).where("aread != bread").groupBy(F.col("aread").alias("contig")).agg(F.count_distinct("bread").alias("reads"))
    share = I.merge(repeats, ["rid"]).groupBy(F.col("rid").alias("contig")).agg(F.sum(F.col("fin") - F.col("beg")).alias("rep"))
    contigs = v("f_reads").select(F.col("rid").alias("contig"), F.col("rlen").alias("len")).join(partners, "contig", "left").join(share, "contig", "left")
    contigs = contigs.select("contig", "len", F.coalesce("reads", F.lit(0)).alias("reads"), F.floor(F.coalesce("rep", F.lit(0)) * 100 / F.col("len")).cast("long").alias("repeat"))
    return G.classify_contigs(relations, contigs, length=12000, reads=20, repeat=10).join(contigs.select("contig", "len"), "contig")


@query("r10_classify_contigs", f"{R10} SELECT contig, kind FROM cl")
def _(v):
    return _classified(v).select("contig", "kind")


@query("r14_classified_report", f"{R10} SELECT kind, COUNT(*) AS contigs, CAST(SUM(len) AS BIGINT) AS bases, MAX(len) AS longest FROM cl GROUP BY 1")
def _(v):
    return _classified(v).groupBy("kind").agg(F.count("*").alias("contigs"), F.sum("len").alias("bases"), F.max("len").alias("longest"))


ENDS = "en AS (SELECT rid AS path, CASE WHEN rid % 3 = 0 THEN -1 ELSE well % 7 END AS end1, CASE WHEN rid % 4 = 0 THEN -1 ELSE tb % 7 END AS end2, rlen * 20 AS len FROM {f_reads})"


def _ends(v):
    return v("f_reads").select(F.col("rid").alias("path"), F.when(F.col("rid") % 3 == 0, -1).otherwise(F.col("well") % 7).alias("end1"), F.when(F.col("rid") % 4 == 0, -1).otherwise(F.col("tb") % 7).alias("end2"), (F.col("rlen") * 20).alias("len"))


@query("r11_tour_relations", f"{ENDS}, r AS (SELECT path, CASE WHEN end1 >= 0 AND end2 >= 0 THEN CASE WHEN end1 = end2 THEN 'bubble' ELSE 'bridge' END WHEN (end1 >= 0 OR end2 >= 0) AND len < 100000 THEN 'spur' END AS relation FROM en) SELECT * FROM r WHERE relation IS NOT NULL")
def _(v):
    return G.tour_relations(_ends(v))


def _tour_ends(v):
    """Ends of the unitigs of f_graph: the path that each end runs into, and the bases of the path's reads."""
    from overlace.operators import graph as GR

    chosen = GR.stored(GR.best_next(v("f_graph")))
    paths = GR.stored(GR.unitigs(chosen))
    size = paths.join(v("f_reads").select("rid", "rlen"), "rid").groupBy("path").agg(F.sum("rlen").alias("len"))
    return GR.end_labels(paths, chosen).join(size, "path")


@query("r11_relations_of_tours")
def _(v):
    return G.tour_relations(_tour_ends(v))


@query("r13_haplotypes_of_tours")
def _(v):
    return G.split_haplotypes(_tour_ends(v))


@query("r13_split_haplotypes", f"{ENDS} SELECT path, CASE WHEN (end1 >= 0 AND end1 = end2) OR ((end1 >= 0) <> (end2 >= 0) AND len < 100000) THEN 'alternative' ELSE 'primary' END AS kind FROM en")
def _(v):
    return G.split_haplotypes(_ends(v))


@query("r12_trim_contigs", """g AS (SELECT aread, bread, MIN(ab) AS ab, MAX(ae) AS ae, SUM(ae - ab) AS bases, MAX(alen) AS alen FROM {f_ovl} WHERE (flags & 2) = 0 AND aread <> bread AND blen > alen GROUP BY 1, 2),
t AS (SELECT aread AS rid, BOOL_OR(bases * 100 >= alen * 50) AS i, MAX(CASE WHEN ab <= 100 THEN ae - 100 ELSE 0 END) AS tb, MIN(CASE WHEN alen - ae <= 100 THEN ab + 100 ELSE alen END) AS te FROM g GROUP BY 1)
SELECT rid, CASE WHEN i OR te <= tb THEN 'contained' ELSE 'trimmed' END AS kind, GREATEST(tb, 0) AS tb, te FROM t""")
def _(v):
    return G.trim_contigs(v("f_ovl"))


@query("r14_contig_report", f"{ENDS}, k AS (SELECT path, len, CASE WHEN (end1 >= 0 AND end1 = end2) OR ((end1 >= 0) <> (end2 >= 0) AND len < 100000) THEN 'alternative' ELSE 'primary' END AS kind FROM en) SELECT kind, COUNT(*) AS contigs, CAST(SUM(len) AS BIGINT) AS bases, MAX(len) AS longest FROM k GROUP BY 1")
def _(v):
    ends = _ends(v)
    return G.split_haplotypes(ends).join(ends.select("path", "len"), "path").groupBy("kind").agg(F.count("*").alias("contigs"), F.sum("len").alias("bases"), F.max("len").alias("longest"))

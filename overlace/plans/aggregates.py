"""Queries of the statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from overlace.operators import alignments as A
from overlace.operators import statistics as T
from overlace.plans.intervals import COMPLEMENT, _anchors
from overlace.plans.overlaps import trim
from overlace.plans.registry import query


@query("a1_read_stats", "s AS (SELECT COUNT(*) AS reads, CAST(SUM(rlen) AS BIGINT) AS bases, SUM(rlen * rlen) AS sq FROM {f_reads}), m AS (SELECT *, FLOOR(bases / reads) AS me FROM s) SELECT reads, bases, CAST(me AS BIGINT) AS mean, CAST(FLOOR(SQRT((sq - 2 * me * bases + reads * me * me) / reads)) AS BIGINT) AS sd FROM m")
def _(v):
    return T.read_stats(v("f_reads"))


HIST = """h AS (SELECT CAST(FLOOR(x / 500) AS BIGINT) AS bin, COUNT(*) AS n, SUM(x) AS bases FROM src GROUP BY 1), c AS (SELECT *, SUM(n) OVER w AS cn, SUM(bases) OVER w AS cb FROM h WINDOW w AS (ORDER BY bin DESC ROWS UNBOUNDED PRECEDING)), t AS (SELECT SUM(n) AS tn, SUM(bases) AS tb FROM h)"""


@query("a2_length_histogram", f"src AS (SELECT rlen AS x FROM {{f_reads}}), {HIST} SELECT bin * 500 AS \"from\", n, ROUND(100.0 * cn / tn, 6) AS pct_reads, ROUND(100.0 * cb / tb, 6) AS pct_bases, CAST(FLOOR(cb / cn) AS BIGINT) AS mean, ROUND(cb / 1000000, 6) AS coverage FROM c, t")
def _(v):
    return T.histogram(v("f_reads"), "rlen", width=500, genome=1_000_000)


@query("a3_overlap_stats", """s AS (SELECT *, ovl_id % 4 AS part FROM {f_ovl}) SELECT part, COUNT(*) AS overlaps, COUNT(DISTINCT aread) AS areads, COUNT(DISTINCT bread) AS breads, COUNT(*) FILTER (aread = bread) AS selfs, COUNT(*) FILTER ((flags & 1) = 0) AS forward, COUNT(*) FILTER ((flags & 1) = 1) AS complement, CAST(FLOOR(AVG(ae - ab)) AS BIGINT) AS mean FROM s GROUP BY ROLLUP(part)""")
def _(v):
    return T.overlap_stats(v("f_ovl"), F.col("ovl_id") % 4)


@query("a4_block_assignment", "SELECT rid, CAST(FLOOR(COALESCE(SUM(rlen) OVER (ORDER BY rid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 200000) AS BIGINT) AS block FROM {f_reads}")
def _(v):
    return T.blocks(v("f_reads"), 200_000)


@query("a4_exact_blocks")
def _(v):
    """Blocks that begin anew where the last one is full."""
    return T.exact_blocks(v("f_reads"), 1_000_000)


@query("a5_overlap_length_histogram", f"src AS (SELECT LEAST(ae - ab, be - bb) AS x FROM {{f_ovl}}), {HIST} SELECT bin * 500 AS \"from\", n, ROUND(100.0 * cn / tn, 6) AS pct_reads, ROUND(100.0 * cb / tb, 6) AS pct_bases, CAST(FLOOR(cb / cn) AS BIGINT) AS mean FROM c, t")
def _(v):
    return T.histogram(v("f_ovl").select(F.least(F.col("ae") - F.col("ab"), F.col("be") - F.col("bb")).alias("x")), "x", width=500)


@query("a6_track_stats", "SELECT track, CAST(FLOOR((fin - beg) / 100) AS BIGINT) * 100 AS \"from\", COUNT(*) AS n, CAST(SUM(fin - beg) AS BIGINT) AS bases FROM {f_track} GROUP BY 1, 2")
def _(v):
    return T.track_stats(v("f_track"))


@query("a7_q_histogram", f"{COMPLEMENT}, s AS (SELECT DISTINCT q.rid, seg, q FROM {{f_q}} q JOIN {{f_reads}} r ON r.rid = q.rid JOIN an ON an.rid = q.rid WHERE te - tb >= 1000 AND seg * 100 >= tb AND seg * 100 + 100 <= te AND fin - beg >= 300 AND seg * 100 >= beg AND seg * 100 + 100 <= fin) SELECT LEAST(q, 100) AS q, COUNT(*) AS n FROM s GROUP BY 1")
def _(v):
    return T.q_histogram(v("f_q"), trim(v), _anchors(v))


A8 = """fu AS (SELECT t.* FROM {f_trace} t JOIN {f_reads} r ON r.rid = t.aread WHERE aread <> bread AND a_from % 100 = 0 AND (a_to % 100 = 0 OR a_to = rlen)),
rk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY aread, seg ORDER BY d, ovl_id) AS k FROM fu), qa AS (SELECT aread AS rid, seg, CAST(FLOOR(AVG(d) + 0.5) AS BIGINT) AS m FROM rk WHERE k <= 20 GROUP BY 1, 2),
es AS (SELECT rid, UNNEST(RANGE(0, CAST(CEIL(rlen / 100) AS BIGINT))) AS seg FROM {f_reads}), q8 AS (SELECT es.rid, es.seg, CASE WHEN m IS NULL THEN 0 WHEN m = 0 THEN 1 ELSE m END AS q FROM es LEFT JOIN qa ON qa.rid = es.rid AND qa.seg = es.seg)"""


@query("a8_segment_quality", f"{A8} SELECT rid, seg, q FROM q8")
def _(v):
    return T.segment_quality(v("f_trace"), v("f_ovl"), v("f_reads"))


W8 = """g AS (SELECT rid, seg, SUM(CASE WHEN q > 0 AND q < 25 THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY seg ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS ok FROM qs),
sp AS (SELECT rid, MIN(seg) * 100 AS b, (MAX(seg) + 5) * 100 AS e FROM g WHERE ok = 5 GROUP BY 1), w8 AS (SELECT r.rid, CASE WHEN LEAST(e, rlen) - b >= 1000 THEN b ELSE 0 END AS tb, CASE WHEN LEAST(e, rlen) - b >= 1000 THEN LEAST(e, rlen) ELSE 0 END AS te FROM {f_reads} r LEFT JOIN sp ON sp.rid = r.rid)"""


@query("w8_trim_by_quality", f"{A8}, qs AS (SELECT * FROM q8), {W8.replace('LEAST(e, rlen) - b >= 1000', 'b IS NOT NULL AND LEAST(e, rlen) - b >= 1000')} SELECT rid, tb, te FROM w8")
def _(v):
    return T.trim_by_quality(T.segment_quality(v("f_trace"), v("f_ovl"), v("f_reads")), v("f_reads"))


@query("w8_exact_trim")
def _(v):
    return T.exact_trim(T.segment_quality(v("f_trace"), v("f_ovl"), v("f_reads")))


@query("w9_tighten_by_quality", f"""k AS (SELECT aread AS rid, MIN(ab) AS lo, MAX(ae) AS hi FROM {{f_ovl}} WHERE (flags & 2) = 0 AND aread <> bread GROUP BY 1), {A8},
bd AS (SELECT r.rid, tb, te, lo, hi, lo IS NULL OR tb < lo OR te > hi AS anew FROM {{f_reads}} r LEFT JOIN k ON k.rid = r.rid),
qs AS (SELECT q8.rid, seg, q FROM q8 JOIN bd ON bd.rid = q8.rid AND anew AND seg >= (lo + 99) // 100 AND seg < hi // 100),
{W8.replace('LEAST(e, rlen) - b >= 1000', 'b IS NOT NULL AND LEAST(e, rlen) - b >= 1000')}
SELECT bd.rid, CASE WHEN anew THEN COALESCE(w8.tb, 0) ELSE bd.tb END AS tb, CASE WHEN anew THEN COALESCE(w8.te, 0) ELSE bd.te END AS te FROM bd LEFT JOIN w8 ON w8.rid = bd.rid""")
def _(v):
    reads = v("f_reads")
    return T.tighten_by_quality(reads.select("rid", "tb", "te"), v("f_ovl"), T.segment_quality(v("f_trace"), v("f_ovl"), reads), reads)


@query("w9_tighten_trim", "k AS (SELECT aread AS rid, MIN(ab) AS lo, MAX(ae) AS hi FROM {f_ovl} WHERE (flags & 2) = 0 AND aread <> bread GROUP BY 1), t AS (SELECT r.rid, lo, GREATEST(tb, CAST(FLOOR((lo + 99) / 100) AS BIGINT) * 100) AS b, LEAST(te, hi) AS e FROM {f_reads} r LEFT JOIN k ON k.rid = r.rid) SELECT rid, CASE WHEN lo IS NOT NULL AND e > b THEN b ELSE 0 END AS tb, CASE WHEN lo IS NOT NULL AND e > b THEN e ELSE 0 END AS te FROM t")
def _(v):
    return T.tighten_trim(trim(v), v("f_ovl"))


@query("a14_n50_stats", "p AS (SELECT rlen, COUNT(*) * rlen AS bases FROM {f_reads} GROUP BY 1), r AS (SELECT rlen, SUM(bases) OVER (ORDER BY rlen DESC ROWS UNBOUNDED PRECEDING) AS run, SUM(bases) OVER () AS total FROM p), x AS (SELECT UNNEST(RANGE(10, 101, 10)) AS x) SELECT CAST(x AS INT) AS x, MAX(CASE WHEN run * 100 >= total * x THEN rlen END) AS n, MAX(CASE WHEN run * 100 >= x * 1000000 THEN rlen END) AS ng FROM r, x GROUP BY 1")
def _(v):
    return T.nx_stats(v("f_reads"), genome=1_000_000)


PAIRS = "m1 AS (SELECT * FROM {f_sam} WHERE mate = 1), m2 AS (SELECT * FROM {f_sam} WHERE mate = 2)"


@query("a15_hic_pair_stats", f"{PAIRS}, p AS (SELECT a.rname AS ref1, b.rname AS ref2, a.pos AS pos1, b.pos AS pos2 FROM m1 a JOIN m2 b ON a.qname = b.qname) SELECT COUNT(*) AS pairs, COUNT(*) FILTER (ref1 = ref2) AS intra, " + ", ".join(f"COUNT(*) FILTER (ref1 = ref2 AND ABS(pos1 - pos2) >= {d}) AS intra_{d}" for d in (1000, 10000, 15000, 20000)) + ", COUNT(*) FILTER (ref1 <> ref2) AS inter FROM p")
def _(v):
    p = A.mates(v("f_sam")).select(F.col("a.rname").alias("ref1"), F.col("b.rname").alias("ref2"), F.col("a.pos").alias("pos1"), F.col("b.pos").alias("pos2"))
    return T.pair_stats(p)


@query("j15_mate_join", f"{PAIRS} SELECT a.qname, a.flag AS flag1, b.flag AS flag2, a.pos AS pos1, b.pos AS pos2 FROM m1 a JOIN m2 b ON a.qname = b.qname")
def _(v):
    return A.mates(v("f_sam")).select("qname", F.col("a.flag").alias("flag1"), F.col("b.flag").alias("flag2"), F.col("a.pos").alias("pos1"), F.col("b.pos").alias("pos2"))


@query("r17_five_prime_filter", """s AS (SELECT *, CASE WHEN (flag & 16) = 0 THEN regexp_matches(cigar, '^[0-9]+M') ELSE regexp_matches(cigar, '[0-9]+M$') END AND (flag & 4) = 0 AS five FROM {f_sam}),
c AS (SELECT *, COUNT(*) OVER (PARTITION BY qname) AS n, COUNT(*) FILTER (five) OVER (PARTITION BY qname) AS nf, ROW_NUMBER() OVER (PARTITION BY qname ORDER BY CASE WHEN five THEN 0 ELSE 1 END, mate) AS k FROM s)
SELECT qname, mate, CASE WHEN nf = 1 AND n <= 2 THEN flag ELSE flag | 4 END AS flag, nf = 1 AND n <= 2 AS kept FROM c WHERE k = 1""")
def _(v):
    return A.five_prime(v("f_sam"))


@query("r18_pair_mates", f"""{PAIRS}, p AS (SELECT a.qname, a.flag AS fa, b.flag AS fb, a.rname AS ra, b.rname AS rb, a.pos AS pa, b.pos AS pb FROM m1 a JOIN m2 b ON a.qname = b.qname WHERE (a.flag & 4) = 0 AND (b.flag & 4) = 0 AND a.mapq >= 10 AND b.mapq >= 10)
SELECT qname, 1 | 2 | 64 | (fa & 16) | (CASE WHEN (fb & 16) = 16 THEN 32 ELSE 0 END) AS flag1, 1 | 2 | 128 | (fb & 16) | (CASE WHEN (fa & 16) = 16 THEN 32 ELSE 0 END) AS flag2, CASE WHEN ra = rb THEN pb - pa ELSE 0 END AS insert FROM p""")
def _(v):
    return A.paired(v("f_sam"), least=10)


@query("s12_sam_rows", "SELECT qname, mate, flag, pos, mapq, cigar FROM {f_sam}")
def _(v):
    return v("f_sam").select("qname", "mate", "flag", "pos", "mapq", "cigar")


HQ = "hq AS (SELECT *, GREATEST(ins_beg, hq_beg) AS beg, LEAST(ins_end, hq_end) AS fin FROM {f_subreads})"


@query("s13_subread_rows", f"{HQ} SELECT well, frag, beg, fin FROM hq WHERE fin - beg >= 500")
def _(v):
    return T.hq_subreads(v("f_subreads")).select("well", "frag", "beg", "fin")


@query("r15_best_subread", f"{HQ}, s AS (SELECT *, 0.2 * (fin - beg) / (hq_end - hq_beg) + 0.4 * avg_qv / MAX(avg_qv) OVER (PARTITION BY well) + 0.4 * (1 - slow_bases / (fin - beg)) AS score FROM hq WHERE fin - beg >= 500) SELECT well, frag, beg, fin FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY well ORDER BY score DESC, frag) AS k FROM s) WHERE k = 1")
def _(v):
    return T.best_subread(v("f_subreads"))


@query("r16_subread_report", f"{HQ} SELECT CAST(FLOOR((fin - beg) / 500) AS BIGINT) * 500 AS \"from\", COUNT(*) AS n, CAST(SUM(fin - beg) AS BIGINT) AS bases, COUNT(DISTINCT well) AS wells, ROUND(AVG(avg_qv), 6) AS qv FROM hq WHERE fin - beg >= 1 GROUP BY 1")
def _(v):
    return T.subread_report(v("f_subreads"))


@query("w21_slow_regions", "s AS (SELECT *, LN((slow_bases + 1) / (ins_end - ins_beg)) AS x FROM {f_subreads}), f AS (SELECT AVG(x) AS m, STDDEV_POP(x) AS sd FROM s) SELECT well, frag FROM s, f WHERE x > m + 2 * sd")
def _(v):
    return T.slow_regions(v("f_subreads"))


@query("s4_best_read_per_well", "SELECT rid, well, rlen FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY well ORDER BY rlen DESC, rid) AS k FROM {f_reads}) WHERE k = 1")
def _(v):
    from overlace.operators.sequences import best_per_well

    return best_per_well(v("f_reads")).select("rid", "well", "rlen")


@query("f8_distribution_fit", "s AS (SELECT AVG(LN(rlen)) AS m, STDDEV_POP(LN(rlen)) AS sd FROM {f_reads}) SELECT rid, ROUND(EXP(-((LN(rlen) - m) * (LN(rlen) - m)) / (2 * sd * sd)) / (sd * SQRT(2 * PI())), 9) AS density FROM {f_reads}, s")
def _(v):
    from overlace.functions.scalar import gaussian_density

    r = v("f_reads")
    fit = r.agg(F.avg(F.log("rlen")).alias("m"), F.stddev_pop(F.log("rlen")).alias("sd"))
    return r.crossJoin(F.broadcast(fit)).select("rid", F.round(gaussian_density(F.log("rlen"), F.col("m"), F.col("sd")), 9).alias("density"))

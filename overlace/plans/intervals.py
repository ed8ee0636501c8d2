"""Queries of sweeps, masks and the interval algebra."""

from __future__ import annotations

from pyspark.sql import functions as F

from overlace.functions.scalar import has
from overlace.operators import coverage as C
from overlace.operators import intervals as I  # noqa: E741
from overlace.plans.registry import query

KEPT = "kept AS (SELECT aread AS rid, ovl_id, ab AS beg, ae AS fin FROM {f_ovl} WHERE (flags & 2) = 0 AND aread <> bread)"
EVENTS = "ev AS (SELECT rid, beg AS pos, 1 AS delta FROM kept UNION ALL SELECT rid, fin - 1, -1 FROM kept), cv AS (SELECT rid, pos, delta, SUM(delta) OVER (PARTITION BY rid ORDER BY pos, delta ROWS UNBOUNDED PRECEDING) AS cov FROM ev)"


def merged(source: str, by: str = "rid", dist: int = 0, name: str = "mg") -> str:
    """SQL of merged intervals of ``source``. Of equal intervals the one that starts an island comes first."""
    return f"""{name}_a AS (SELECT *, CASE WHEN beg > MAX(fin) OVER (PARTITION BY {by} ORDER BY beg, fin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + {dist} THEN 1 ELSE 0 END AS st FROM {source}),
{name}_b AS (SELECT *, SUM(st) OVER (PARTITION BY {by} ORDER BY beg, fin, st DESC ROWS UNBOUNDED PRECEDING) AS isl FROM {name}_a),
{name} AS (SELECT {by}, MIN(beg) AS beg, MAX(fin) AS fin, COUNT(*) AS n FROM {name}_b GROUP BY {by}, isl)"""


def hysteresis(source: str, enter: str, leave: str, name: str = "hy") -> str:
    """SQL of intervals by hysteresis of coverage. Equal events keep the order of the running sum: coverage rises over equal begins and falls over equal ends."""
    return f"""{name}_s AS (SELECT rid, pos, delta, cov * delta AS turn, COALESCE(LAST_VALUE(CASE WHEN cov > {enter} THEN 1 WHEN cov < {leave} THEN 0 END IGNORE NULLS) OVER (PARTITION BY rid ORDER BY pos, delta, cov * delta ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS state FROM {source}),
{name}_p AS (SELECT *, COALESCE(LAG(state) OVER (PARTITION BY rid ORDER BY pos, delta, turn), 0) AS bef FROM {name}_s),
{name}_n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY rid, state ORDER BY pos, delta) AS k FROM {name}_p WHERE state <> bef),
{name} AS (SELECT rid, MIN(CASE WHEN state = 1 THEN pos END) AS beg, MAX(CASE WHEN state = 0 THEN pos END) AS fin FROM {name}_n GROUP BY rid, k HAVING MAX(CASE WHEN state = 0 THEN pos END) > MIN(CASE WHEN state = 1 THEN pos END))"""


REPEATS = f"{KEPT}, {EVENTS}, {hysteresis('cv', '20', '17')}"


@query("w1_coverage_sweep", f"{KEPT}, {EVENTS} SELECT rid, pos, CAST(delta AS INT) AS delta, CAST(cov AS BIGINT) AS cov FROM cv")
def _(v):
    return C.coverage_sweep(v("f_ovl")).select("rid", "pos", "delta", "cov")


@query("w2_repeat_hysteresis", f"{REPEATS}, {merged('hy')} SELECT rid, beg, fin FROM mg")
def _(v):
    return C.repeats(v("f_ovl"), 10)


@query("w3_repeat_edge_extension", f"""{REPEATS}, {merged('hy')}, j AS (SELECT m.rid, m.beg, m.fin, MAX(alen) AS alen, COUNT(*) FILTER (ab = 0 AND ABS(ae - m.fin) <= 200) AS l, COUNT(*) FILTER (ae = alen AND ABS(ab - m.beg) <= 200) AS r
 FROM mg m LEFT JOIN (SELECT * FROM {{f_ovl}} WHERE (flags & 2) = 0) o ON o.aread = m.rid GROUP BY 1, 2, 3)
SELECT rid, CASE WHEN beg <= 1000 AND l > 2 THEN 0 ELSE beg END AS beg, CASE WHEN alen - fin <= 1000 AND r > 2 THEN alen ELSE fin END AS fin FROM j""")
def _(v):
    return C.extend_to_ends(C.repeats(v("f_ovl"), 10), v("f_ovl"))


LOCAL = "((ab > 0 AND (CASE WHEN (flags & 1) = 1 THEN blen - be ELSE bb END) > 0) OR (alen - ae > 0 AND (CASE WHEN (flags & 1) = 1 THEN bb ELSE blen - be END) > 0))"


@query("w4_local_end_repeats", f"kept AS (SELECT aread AS rid, ab AS beg, ae AS fin FROM {{f_ovl}} WHERE (flags & 2) = 0 AND aread <> bread AND {LOCAL}), {EVENTS}, {hysteresis('cv', '12', '8')}, {merged('hy', dist=500)} SELECT rid, beg, fin FROM mg")
def _(v):
    return C.local_repeats(v("f_ovl"), enter=12, leave=8, dist=500)


@query("w5_tandem_mask", f"own AS (SELECT aread AS rid, bb AS beg, ae AS fin FROM {{f_ovl}} WHERE aread = bread AND ab - be <= 20 AND ae - bb > 500), {merged('own')} SELECT rid, beg, fin FROM mg")
def _(v):
    return C.tandem_mask(v("f_ovl"))


@query("w10_gap_bins", f"""{KEPT}, s AS (SELECT rid, CAST(FLOOR((beg + 549) / 100) AS BIGINT) AS a, CAST(FLOOR((fin - 450) / 100) AS BIGINT) - 1 AS b FROM kept),
g AS (SELECT rid, bin, COUNT(*) AS n FROM (SELECT rid, UNNEST(RANGE(a, b + 1)) AS bin FROM s WHERE b >= a) GROUP BY 1, 2),
h AS (SELECT rid, bin, LEAD(bin) OVER (PARTITION BY rid ORDER BY bin) AS nx FROM g WHERE n > 1)
SELECT rid, (bin + 1) * 100 AS beg, nx * 100 AS fin FROM h WHERE nx > bin + 1""")
def _(v):
    return C.breaks(v("f_ovl"))


@query("w12_window_gap_check", """kept AS (SELECT aread, bread, MIN(ab) AS beg, MAX(ae) AS fin FROM {f_ovl} WHERE (flags & 2) = 0 AND aread <> bread GROUP BY 1, 2),
l AS (SELECT aread AS rid, MAX(alen) AS alen FROM {f_ovl} WHERE (flags & 2) = 0 AND aread <> bread GROUP BY 1),
st AS (SELECT rid, UNNEST(RANGE(1000, alen - 1000 + 1, 1000)) AS pos FROM l WHERE alen > 2000)
SELECT rid, pos, COUNT(bread) AS n FROM st LEFT JOIN kept ON aread = rid AND beg + 200 <= pos AND fin - 200 >= pos GROUP BY 1, 2 HAVING COUNT(bread) < 2""")
def _(v):
    return C.window_gaps(v("f_ovl"))


@query("w13_tip_coverage", f"""{KEPT}, t AS (SELECT k.*, tb, te FROM kept k JOIN {{f_reads}} r ON r.rid = k.rid), {merged('kept')},
c AS (SELECT rid, SUM(fin - beg) AS cov FROM mg GROUP BY 1), n AS (SELECT rid, COUNT(*) FILTER (beg <= tb) AS "left", COUNT(*) FILTER (fin >= te) AS "right", SUM(fin - beg) AS bases FROM t GROUP BY 1)
SELECT n.rid, "left", "right", CAST(FLOOR(bases * 10 / cov) AS BIGINT) AS cov10, "left" = 0 OR "right" = 0 OR FLOOR(bases * 10 / cov) < 20 AS bad FROM n JOIN c ON n.rid = c.rid""")
def _(v):
    return C.tip_coverage(v("f_ovl"), v("f_reads").select("rid", "tb", "te"))


@query("w14_chimer_walls", """side AS (SELECT * FROM {f_ovl} WHERE (flags & 2) = 0 AND aread <> bread),
e AS (SELECT aread AS rid, CAST(FLOOR(ae / 100) AS BIGINT) AS bin, COUNT(*) AS n FROM side WHERE ae < alen GROUP BY 1, 2),
b AS (SELECT aread AS rid, CAST(FLOOR(ab / 100) AS BIGINT) AS bin, COUNT(*) AS n FROM side WHERE ab > 0 GROUP BY 1, 2),
ew AS (SELECT rid, bin FROM (SELECT rid, bin, CASE WHEN LEAD(bin) OVER w = bin + 1 THEN n + LEAD(n) OVER w ELSE n END AS n2 FROM e WINDOW w AS (PARTITION BY rid ORDER BY bin)) WHERE n2 >= 5),
bw AS (SELECT rid, bin FROM (SELECT rid, bin, CASE WHEN LEAD(bin) OVER w = bin + 1 THEN n + LEAD(n) OVER w ELSE n END AS n2 FROM b WINDOW w AS (PARTITION BY rid ORDER BY bin)) WHERE n2 >= 5),
p AS (SELECT ew.rid, ew.bin AS eb, bw.bin AS bb FROM ew JOIN bw ON ew.rid = bw.rid AND bw.bin >= ew.bin AND (bw.bin - ew.bin) * 100 <= 12000)
SELECT rid, eb * 100 AS end_wall, bb * 100 AS begin_wall FROM p WHERE NOT EXISTS (SELECT 1 FROM side s WHERE s.aread = p.rid AND s.ab < p.eb * 100 AND s.ae > (p.bb + 1) * 100)""")
def _(v):
    return C.walls(v("f_ovl"))


@query("w15_chimer_spans", f"""{KEPT}, s AS (SELECT DISTINCT rid, fin AS pos FROM kept), c AS (SELECT s.rid, s.pos, COUNT(k.rid) AS spanning FROM s LEFT JOIN kept k ON k.rid = s.rid AND k.beg <= s.pos - 100 AND k.fin >= s.pos + 100 GROUP BY 1, 2)
SELECT rid, pos, spanning FROM c WHERE spanning < 1""")
def _(v):
    return C.chimer_spans(v("f_ovl"))


@query("a9_mode_coverage", f"""kept AS (SELECT aread AS rid, ab AS beg, ae AS fin FROM {{f_ovl}} o JOIN {{f_reads}} r ON r.rid = aread AND best = 1 WHERE (flags & 2) = 0 AND aread <> bread), {merged('kept')},
c AS (SELECT rid, SUM(fin - beg) AS cov FROM mg GROUP BY 1), b AS (SELECT rid, SUM(fin - beg) AS bases FROM kept GROUP BY 1),
h AS (SELECT q AS cov, COUNT(*) AS reads FROM (SELECT CAST(FLOOR(bases / cov) AS BIGINT) AS q FROM b JOIN c ON b.rid = c.rid) WHERE q < 100 GROUP BY 1)
SELECT cov, reads FROM h ORDER BY reads DESC, cov LIMIT 1""")
def _(v):
    return C.mode_coverage(v("f_ovl"), v("f_reads"))


@query("a16_effective_coverage", f"{KEPT}, {merged('kept')}, c AS (SELECT rid, SUM(fin - beg) AS covered FROM mg GROUP BY 1), b AS (SELECT rid, SUM(fin - beg) AS bases FROM kept GROUP BY 1) SELECT b.rid, CAST(bases AS BIGINT) AS bases, CAST(covered AS BIGINT) AS covered, CAST(FLOOR(bases / covered) AS BIGINT) AS cov FROM b JOIN c ON b.rid = c.rid")
def _(v):
    return C.read_coverage(v("f_ovl"))


@query("i1_combine", f"s AS (SELECT rid, beg, fin FROM {{f_track}}), {merged('s')} SELECT rid, beg, fin FROM mg")
def _(v):
    return I.merge(v("f_track"), ["rid"]).select("rid", "beg", "fin")


@query("i2_concat_blocks", "b AS (SELECT rid, track, beg, fin, rid % 4 AS block FROM {f_track}) SELECT rid, track, COUNT(*) AS n, COUNT(DISTINCT block) = 1 AS ok FROM b GROUP BY 1, 2")
def _(v):
    blocks = v("f_track").withColumn("block", F.col("rid") % 4)
    return blocks.groupBy("rid", "track").agg(F.count("*").alias("n"), (F.count_distinct("block") == 1).alias("ok"))


@query("i3_trim_track", "t AS (SELECT t.rid, track, GREATEST(beg, 500) AS beg, LEAST(fin, rlen - 500) AS fin FROM {f_track} t JOIN {f_reads} r ON t.rid = r.rid) SELECT * FROM t WHERE fin > beg")
def _(v):
    t = v("f_track").join(v("f_reads").select("rid", "rlen"), "rid")
    return t.select("rid", "track", F.greatest("beg", F.lit(500)).alias("beg"), F.least("fin", F.col("rlen") - 500).alias("fin")).where("fin > beg")


COMPLEMENT = f"""cl AS (SELECT t.rid, GREATEST(beg, tb) AS beg, LEAST(fin, te) AS fin FROM {{f_track}} t JOIN {{f_reads}} r ON t.rid = r.rid WHERE track = 'repeats' AND LEAST(fin, te) > GREATEST(beg, tb)),
al AS (SELECT * FROM cl UNION ALL SELECT rid, tb, tb FROM {{f_reads}} WHERE te > tb UNION ALL SELECT rid, te, te FROM {{f_reads}} WHERE te > tb), {merged('al')},
nx AS (SELECT rid, fin AS beg, LEAD(beg) OVER (PARTITION BY rid ORDER BY beg) AS fin FROM mg), an AS (SELECT rid, beg, fin FROM nx WHERE fin - beg >= 10)"""


def _anchors(v):
    return I.complement(v("f_track").where("track = 'repeats'").select("rid", "beg", "fin"), v("f_reads").select("rid", F.col("tb").alias("lo"), F.col("te").alias("hi")), shortest=10)


@query("i5_invert_anchors", f"{COMPLEMENT} SELECT rid, beg, fin FROM an")
def _(v):
    return _anchors(v)


@query("i6_tip_merge", f"{COMPLEMENT}, c AS (SELECT an.rid, CASE WHEN beg > tb THEN GREATEST(beg, tb + 1000) ELSE CASE WHEN fin >= tb + 1000 THEN beg ELSE GREATEST(beg, tb + 1000) END END AS beg, CASE WHEN fin < te THEN LEAST(fin, te - 1000) ELSE CASE WHEN beg <= te - 1000 THEN fin ELSE LEAST(fin, te - 1000) END END AS fin FROM an JOIN {{f_reads}} r ON r.rid = an.rid) SELECT rid, beg, fin FROM c WHERE fin > beg")
def _(v):
    """Anchors inside the first or last 1000 bases are clipped, unless one covers the whole tip."""
    a = _anchors(v).join(v("f_reads").select("rid", "tb", "te"), "rid")
    covers_left, covers_right = (F.col("beg") <= F.col("tb")) & (F.col("fin") >= F.col("tb") + 1000), (F.col("fin") >= F.col("te")) & (F.col("beg") <= F.col("te") - 1000)
    beg = F.when(covers_left, F.col("beg")).otherwise(F.greatest("beg", F.col("tb") + 1000))
    fin = F.when(covers_right, F.col("fin")).otherwise(F.least("fin", F.col("te") - 1000))
    return a.select("rid", beg.alias("beg"), fin.alias("fin")).where("fin > beg")


@query("i7_track_gap", "s AS (SELECT DISTINCT rid, track, beg, fin FROM {f_track}), g AS (SELECT rid, track, beg, fin, beg - LAG(fin) OVER (PARTITION BY rid, track ORDER BY beg, fin) AS gap FROM s) SELECT * FROM g WHERE gap IS NOT NULL")
def _(v):
    from pyspark.sql import Window as W

    w = W.partitionBy("rid", "track").orderBy("beg", "fin")
    return v("f_track").distinct().withColumn("gap", F.col("beg") - F.lag("fin").over(w)).where("gap is not null")


@query("j10_interval_intersect", "o AS (SELECT ovl_id, aread AS rid, ab, ae FROM {f_ovl}) SELECT ovl_id, CAST(COALESCE(SUM(CASE WHEN t.rid IS NOT NULL THEN LEAST(ae, fin) - GREATEST(ab, beg) END), 0) AS BIGINT) AS inside, COALESCE(MAX(CASE WHEN t.rid IS NOT NULL THEN LEAST(ae, fin) - GREATEST(ab, beg) END), 0) AS longest FROM o LEFT JOIN (SELECT * FROM {f_track} WHERE track = 'repeats') t ON t.rid = o.rid AND beg < ae AND ab < fin GROUP BY 1")
def _(v):
    o = v("f_ovl").select("ovl_id", F.col("aread").alias("rid"), F.col("ab").alias("beg"), F.col("ae").alias("fin"))
    return I.intersect_sums(o, v("f_track").where("track = 'repeats'").select("rid", "beg", "fin"), "ovl_id")


@query("p19_spanning_repeats", "t AS (SELECT t.rid, beg, fin, tb, te FROM {f_track} t JOIN {f_reads} r ON r.rid = t.rid WHERE track = 'repeats') SELECT rid, beg, fin FROM t WHERE beg - tb >= 300 AND te - fin >= 300")
def _(v):
    t = v("f_track").where("track = 'repeats'").join(v("f_reads").select("rid", "tb", "te"), "rid")
    return t.where("beg - tb >= 300 and te - fin >= 300").select("rid", "beg", "fin")


@query("f4_interval_predicates", "a AS (SELECT t.rid, t.beg, t.fin, tb, te FROM {f_track} t JOIN {f_reads} r ON r.rid = t.rid) SELECT rid, beg, fin, GREATEST(0, LEAST(fin, te) - GREATEST(beg, tb)) AS shared, beg >= tb AND fin <= te AS inside FROM a")
def _(v):
    from overlace.functions.scalar import contained, intersection

    a = v("f_track").join(v("f_reads").select("rid", "tb", "te"), "rid")
    c = F.col
    return a.select("rid", "beg", "fin", intersection(c("beg"), c("fin"), c("tb"), c("te")).alias("shared"), contained(c("beg"), c("fin"), c("tb"), c("te")).alias("inside"))



@query("w15_walked_chimers", """o AS (SELECT aread AS rid, ab, ae, ROW_NUMBER() OVER (PARTITION BY aread ORDER BY bread, flags & 1, ab, ae, bb, be, ovl_id) AS k FROM {f_ovl} WHERE (flags & 2) = 0),
n AS (SELECT aread AS rid, COUNT(*) AS n FROM {f_ovl} GROUP BY 1),
x AS (SELECT o.rid, MIN(ab) AS lo, GREATEST(MAX(ae), MIN(tb)) AS hi, MAX(k) AS ks FROM o JOIN {f_reads} r ON r.rid = o.rid JOIN n ON n.rid = o.rid AND n.n >= 1 GROUP BY 1 HAVING MIN(ab) < MIN(te)),
st AS (SELECT x.rid, lo, hi, ks, COUNT(*) FILTER (ab = lo) AS f, COUNT(*) FILTER (ae = hi) AS l, MAX(ae) FILTER (ab = lo) AS pl FROM x JOIN o ON o.rid = x.rid GROUP BY 1, 2, 3, 4),
w AS (SELECT rid, lo, hi, ks, CAST(0 AS BIGINT) AS k, pl, pl AS far, 0 AS seen, FALSE AS ok FROM st WHERE f >= 1 AND l >= 1 AND pl < hi
 UNION ALL SELECT rid, lo, hi, ks, k, CASE WHEN mv THEN far ELSE pl END, far, CASE WHEN mv THEN 0 ELSE seen END, ok FROM (
  SELECT rid, lo, hi, ks, nk AS k, pl, ok OR pl = hi AS ok, CASE WHEN sp THEN GREATEST(far, ae) ELSE far END AS far, seen + CASE WHEN sp THEN 1 ELSE 0 END AS seen, seen + CASE WHEN sp THEN 1 ELSE 0 END >= 1 AS mv
  FROM (SELECT w.*, o.k AS nk, o.ae, pl < hi AND o.ab <= pl - LEAST(100, pl - lo) AND o.ae >= pl + LEAST(100, hi - pl) AS sp FROM w JOIN o ON o.rid = w.rid AND o.k = w.k + 1) y) z)
SELECT rid, CAST(NULL AS BIGINT) AS pos, 'overlaps' AS why FROM n WHERE n < 1 UNION ALL SELECT rid, NULL, 'ends' FROM st WHERE f < 1 OR l < 1 UNION ALL SELECT rid, pl, 'gap' FROM w WHERE k = ks AND NOT ok""")
def _(v):
    return C.walked_chimers(v("f_ovl"), v("f_reads").select("rid", "tb", "te"))


GAPS = """al AS (SELECT *, flags & 1 AS comp, ROW_NUMBER() OVER (PARTITION BY aread, bread ORDER BY flags & 1, ab, ae, bb, be, ovl_id) AS k FROM {f_ovl} WHERE (flags & 2) = 0 AND aread <> bread),
tw AS (SELECT DISTINCT a.ovl_id FROM al a JOIN al b ON a.aread = b.aread AND a.bread = b.bread AND a.k <> b.k AND a.ab < b.ae AND b.ab < a.ae AND (b.ae - b.ab > a.ae - a.ab OR (b.ae - b.ab = a.ae - a.ab AND b.k < a.k))),
sd AS (SELECT aread AS rid, (ab + 450) // 100 AS b, CAST(FLOOR((ae - 450) / 100) AS BIGINT) AS e FROM al WHERE ovl_id NOT IN (SELECT ovl_id FROM tw)),
wh AS (SELECT rid, MIN(b) AS lo, MAX(e) AS hi FROM sd GROUP BY 1 HAVING MAX(e) > MIN(b)),
ct AS (SELECT rid, bin, COUNT(*) AS n FROM (SELECT rid, UNNEST(RANGE(b, e)) AS bin FROM sd WHERE e > b) GROUP BY 1, 2),
lw AS (SELECT rid, hi, bin, bin - ROW_NUMBER() OVER (PARTITION BY rid ORDER BY bin) AS isl FROM (SELECT w.rid, w.hi, w.bin FROM (SELECT rid, hi, UNNEST(RANGE(lo, hi)) AS bin FROM wh) w LEFT JOIN ct ON ct.rid = w.rid AND ct.bin = w.bin WHERE COALESCE(n, 0) <= 1)),
br AS (SELECT rid, MIN(bin) * 100 - 100 AS beg, (MAX(bin) + 2) * 100 AS fin, MAX(bin) + 1 = hi AS at_end FROM lw GROUP BY rid, hi, isl),
sh AS (SELECT *, flags & 1 AS comp FROM {f_ovl} WHERE (flags & (2048 + 32768 + 131072 + 128)) = 0 AND ovl_id NOT IN (SELECT ovl_id FROM tw)),
bg AS (SELECT a.aread AS rid, a.ab, b.ae FROM sh a JOIN sh b ON a.aread = b.aread AND a.bread = b.bread AND a.comp = b.comp AND (b.ab, b.ae, b.bb, b.be, b.ovl_id) > (a.ab, a.ae, a.bb, a.be, a.ovl_id) AND ABS(a.ae - b.ab) < 400 AND ABS(a.be - b.bb) < 400),
wr AS (SELECT rid, beg, fin, at_end, NOT at_end AND (EXISTS (SELECT 1 FROM {f_track} t WHERE t.rid = br.rid AND t.beg < br.beg AND t.fin > br.fin) OR EXISTS (SELECT 1 FROM bg WHERE bg.rid = br.rid AND bg.ab < br.beg - 450 AND bg.ae > br.fin + 450)) AS kept FROM br)"""


@query("w10_weak_runs", f"{GAPS} SELECT rid, beg, fin, at_end, kept FROM wr")
def _(v):
    return C.weak_runs(v("f_ovl"), exclude=v("f_track"), fuzz=400)


@query("w10_break_drops", f"""{GAPS}, bs AS (SELECT aread AS rid, ab AS start FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY aread ORDER BY ab - ae, bread, flags & 1, ab, ae, bb, be, ovl_id) AS i FROM {{f_ovl}} WHERE (flags & 2) = 0) WHERE i = 1),
lm AS (SELECT wr.rid, MAX(beg) FILTER (beg <= start) AS lo, MIN(fin) FILTER (beg > start) AS hi FROM wr JOIN bs ON bs.rid = wr.rid WHERE NOT kept GROUP BY 1)
SELECT ovl_id, aread AS rid FROM {{f_ovl}} JOIN lm ON lm.rid = aread WHERE (flags & 2) = 0 AND (ab < lo OR ae > hi)""")
def _(v):
    ovl = v("f_ovl")
    runs = C.weak_runs(ovl, exclude=v("f_track"), fuzz=400)
    return C.drop_at_breaks(ovl.where("(flags & 2) = 0"), runs).where(has(F.col("flags"), "gap")).select("ovl_id", F.col("aread").alias("rid"))

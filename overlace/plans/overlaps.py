"""Queries of the overlap filters, flags, joins and per-pair rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from overlace.functions import scalar as S
from overlace.operators import overlaps as O  # noqa: E741
from overlace.plans.intervals import merged
from overlace.plans.registry import query

TRIMMED = """tr AS (SELECT o.*, a.tb AS ta_b, a.te AS ta_e, CASE WHEN (o.flags & 1) = 1 THEN o.blen - b.te ELSE b.tb END AS tb_b, CASE WHEN (o.flags & 1) = 1 THEN o.blen - b.tb ELSE b.te END AS tb_e
 FROM {f_ovl} o JOIN {f_reads} a ON a.rid = o.aread JOIN {f_reads} b ON b.rid = o.bread)"""


def trim(v):
    return v("f_reads").select("rid", "tb", "te")


def flags(df):
    return df.select("ovl_id", "flags")


def set_bit(when: str, name: str) -> str:
    return f"CASE WHEN (flags & 2) = 0 AND ({when}) THEN flags | {S.bit(name) | 2} ELSE flags END AS flags"


@query("p1_purge_discarded", "SELECT * FROM {f_ovl} WHERE (flags & 2) = 0")
def _(v):
    return O.purge(v("f_ovl"))


@query("p2_min_read_length", f"{TRIMMED} SELECT ovl_id, {set_bit('LEAST(ta_e - ta_b, tb_e - tb_b) < 6000', 'rlen')} FROM tr")
def _(v):
    return flags(O.min_read_length(v("f_ovl"), trim(v), 6000))


@query("p3_min_overlap_length", f"SELECT ovl_id, {set_bit('LEAST(ae - ab, be - bb) < 1500', 'olen')} FROM {{f_ovl}}")
def _(v):
    return flags(O.min_overlap_length(v("f_ovl"), 1500))


@query("p4_local_alignment", f"{TRIMMED} SELECT ovl_id, {set_bit('(ab - ta_b > 1000 AND bb - tb_b > 1000) OR (ta_e - ae > 1000 AND tb_e - be > 1000)', 'local')} FROM tr")
def _(v):
    return flags(O.local_alignment(v("f_ovl"), trim(v), 1000))


@query("p5_max_divergence", f"SELECT ovl_id, {set_bit('100.0 * diffs / LEAST(ae - ab, be - bb) > 20', 'diff')} FROM {{f_ovl}}")
def _(v):
    return flags(O.max_divergence(v("f_ovl"), 20))


REP = f"rp AS (SELECT rid, beg, fin FROM {{f_track}} WHERE track = 'repeats'), {merged('rp')}"


@query("p6_nonrepeat_bases", f"""{REP}, o AS (SELECT ovl_id, flags, aread, bread, ab, ae, be - bb AS bl, CASE WHEN (flags & 1) = 1 THEN blen - be ELSE bb END AS b1, CASE WHEN (flags & 1) = 1 THEN blen - bb ELSE be END AS b2 FROM {{f_ovl}}),
x AS (SELECT ovl_id, SUM(LEAST(ae, fin) - GREATEST(ab, beg)) AS a_rep FROM o JOIN mg ON mg.rid = aread AND beg < ae AND ab < fin GROUP BY 1),
y AS (SELECT ovl_id, SUM(LEAST(b2, fin) - GREATEST(b1, beg)) AS b_rep FROM o JOIN mg ON mg.rid = bread AND beg < b2 AND b1 < fin GROUP BY 1),
z AS (SELECT o.*, COALESCE(a_rep, 0) AS a_rep, COALESCE(b_rep, 0) AS b_rep FROM o LEFT JOIN x ON x.ovl_id = o.ovl_id LEFT JOIN y ON y.ovl_id = o.ovl_id)
SELECT ovl_id, {set_bit('ae - ab - a_rep < 800 OR bl - b_rep < 800', 'repeat')} FROM z""")
def _(v):
    return flags(O.nonrepeat_bases(v("f_ovl"), v("f_track").where("track = 'repeats'").select("rid", "beg", "fin"), 800))


@query("p7_merge_tip_repeats", f"""{REP}, s AS (SELECT r.rid, SUM(CASE WHEN mg.rid IS NULL THEN 0 ELSE GREATEST(0, LEAST(fin, tb + 1500) - GREATEST(beg, tb)) END) AS l, SUM(CASE WHEN mg.rid IS NULL THEN 0 ELSE GREATEST(0, LEAST(fin, te) - GREATEST(beg, te - 1500)) END) AS r FROM {{f_reads}} r LEFT JOIN mg ON mg.rid = r.rid WHERE te > tb GROUP BY 1)
SELECT rid, l > 501 AS "left", r > 501 AS "right" FROM s""")
def _(v):
    return O.merged_tips(v("f_track").where("track = 'repeats'").select("rid", "beg", "fin"), trim(v), 1500)


TIPS = f"""{REP}, tp AS (SELECT r.rid, r.tb, r.te, SUM(CASE WHEN mg.rid IS NULL THEN 0 ELSE GREATEST(0, LEAST(fin, tb + 1500) - GREATEST(beg, tb)) END) > 501 AS l, SUM(CASE WHEN mg.rid IS NULL THEN 0 ELSE GREATEST(0, LEAST(fin, te) - GREATEST(beg, te - 1500)) END) > 501 AS r FROM {{f_reads}} r LEFT JOIN mg ON mg.rid = r.rid WHERE te > tb GROUP BY 1, 2, 3)"""


@query("p7_tip_window", f"""{TIPS}, o0 AS (SELECT o.ovl_id, flags, aread, bread, be - bb AS bl, CASE WHEN (flags & 1) = 1 THEN blen - be ELSE bb END AS b1, CASE WHEN (flags & 1) = 1 THEN blen - bb ELSE be END AS b2,
 CASE WHEN l THEN GREATEST(ab, tb + 1500) ELSE ab END AS ab, CASE WHEN r THEN LEAST(ae, te - 1500) ELSE ae END AS ae FROM {{f_ovl}} o LEFT JOIN tp ON tp.rid = aread), o AS (SELECT * REPLACE (GREATEST(ab, ae) AS ae) FROM o0),
x AS (SELECT ovl_id, SUM(LEAST(ae, fin) - GREATEST(ab, beg)) AS a_rep FROM o JOIN mg ON mg.rid = aread AND beg < ae AND ab < fin GROUP BY 1),
y AS (SELECT ovl_id, SUM(LEAST(b2, fin) - GREATEST(b1, beg)) AS b_rep FROM o JOIN mg ON mg.rid = bread AND beg < b2 AND b1 < fin GROUP BY 1),
z AS (SELECT o.*, COALESCE(a_rep, 0) AS a_rep, COALESCE(b_rep, 0) AS b_rep FROM o LEFT JOIN x ON x.ovl_id = o.ovl_id LEFT JOIN y ON y.ovl_id = o.ovl_id)
SELECT ovl_id, {set_bit('ae - ab - a_rep < 800 OR bl - b_rep < 800', 'repeat')} FROM z""")
def _(v):
    """P6 with A's window moved by P7."""
    repeats = v("f_track").where("track = 'repeats'").select("rid", "beg", "fin")
    return flags(O.nonrepeat_bases(v("f_ovl"), repeats, 800, tips=O.merged_tips(repeats, trim(v), 1500).join(trim(v), "rid"), tip=1500))


ANCHORS = f"""rp AS (SELECT rid, beg, fin FROM {{f_track}} WHERE track = 'repeats'), {merged('rp', name='mr')}, du AS (SELECT rid, beg, fin FROM {{f_track}} WHERE track = 'dust'), {merged('du', name='md')},
ed AS (SELECT rid, beg, fin FROM mr UNION ALL SELECT rid, 0, 0 FROM {{f_reads}} UNION ALL SELECT rid, rlen, rlen FROM {{f_reads}}), {merged('ed', name='me')}, nx AS (SELECT rid, fin AS beg, LEAD(beg) OVER (PARTITION BY rid ORDER BY beg) AS fin FROM me),
an AS (SELECT nx.rid, rlen, GREATEST(beg, tb) AS beg, LEAST(fin, te) AS fin FROM nx JOIN {{f_reads}} r ON r.rid = nx.rid WHERE fin - beg >= 11 AND LEAST(fin, te) > GREATEST(beg, tb)),
fl AS (SELECT rid, beg, fin, beg AS lo, fin AS hi, 0 AS w FROM an WHERE fin - beg <= 600 UNION ALL SELECT rid, beg, fin, GREATEST(0, beg - w), beg, w FROM an, (VALUES (100), (200), (250)) v(w) WHERE fin - beg <= 600 UNION ALL SELECT rid, beg, fin, fin, LEAST(rlen, fin + w), w FROM an, (VALUES (100), (200), (250)) v(w) WHERE fin - beg <= 600),
st AS (SELECT f.rid, f.beg, f.fin, f.lo, f.hi, w, COALESCE(SUM(CASE WHEN md.rid IS NOT NULL THEN LEAST(hi, md.fin) - GREATEST(lo, md.beg) END), 0) AS d, COALESCE(MAX(CASE WHEN md.rid IS NOT NULL THEN LEAST(hi, md.fin) - GREATEST(lo, md.beg) END), 0) AS g FROM fl f LEFT JOIN md ON md.rid = f.rid AND md.beg < hi AND lo < md.fin GROUP BY 1, 2, 3, 4, 5, 6),
bd AS (SELECT DISTINCT rid, beg, fin FROM st WHERE CASE WHEN w = 0 THEN 100.0 * d / (fin - beg) > 50 OR (100.0 * d / (fin - beg) > 15 AND g > 100) OR (fin - beg < 100 AND g > 20) ELSE 100.0 * d / w > 20 AND g > 30 END),
kp AS (SELECT rid, beg, fin FROM an WHERE NOT EXISTS (SELECT 1 FROM bd WHERE bd.rid = an.rid AND bd.beg = an.beg AND bd.fin = an.fin)),
ct AS (SELECT k.rid, k.beg, k.fin, GREATEST(k.beg, md.beg) AS c1, LEAST(k.fin, md.fin) AS c2 FROM kp k JOIN md ON md.rid = k.rid AND md.beg < k.fin AND k.beg < md.fin),
ua AS (SELECT rid, beg, fin FROM kp WHERE NOT EXISTS (SELECT 1 FROM ct WHERE ct.rid = kp.rid AND ct.beg = kp.beg AND ct.fin = kp.fin) UNION ALL SELECT rid, COALESCE(LAG(c2) OVER (PARTITION BY rid, beg, fin ORDER BY c1), beg), c1 FROM ct UNION ALL SELECT rid, MAX(c2), fin FROM ct GROUP BY rid, beg, fin),
mg AS (SELECT * FROM ua WHERE fin > beg)"""


@query("p8_anchor_bases_lowcomp", f"""{ANCHORS}, x AS (SELECT ovl_id, SUM(LEAST(ae, fin) - GREATEST(ab, beg)) AS free FROM {{f_ovl}} JOIN mg ON mg.rid = aread AND beg < ae AND ab < fin GROUP BY 1), z AS (SELECT o.*, COALESCE(free, 0) AS free FROM {{f_ovl}} o LEFT JOIN x ON x.ovl_id = o.ovl_id)
SELECT ovl_id, {set_bit('free < 600', 'repeat')} FROM z""")
def _(v):
    t = v("f_track")
    anchors = O.unique_anchors(t.where("track = 'repeats'"), t.where("track = 'dust'"), v("f_reads").select("rid", "rlen", "tb", "te"), join=600, tip=250)
    return flags(O.anchor_bases(v("f_ovl"), anchors, 600))


@query("p9_trace_sum_check", "s AS (SELECT ovl_id, CAST(SUM(blen) AS BIGINT) AS found FROM {f_trace} GROUP BY 1) SELECT o.ovl_id, be - bb AS expected, COALESCE(found, 0) AS found FROM {f_ovl} o LEFT JOIN s ON s.ovl_id = o.ovl_id WHERE be - bb <> COALESCE(found, 0)")
def _(v):
    return O.trace_sum_check(v("f_ovl"), v("f_trace"))


@query("p10_segment_error", f"m AS (SELECT *, MAX(seg) OVER (PARTITION BY ovl_id) AS last FROM {{f_trace}}), w AS (SELECT ovl_id, MAX(100.0 * d / blen) AS worst FROM m WHERE seg < last AND blen > 0 GROUP BY 1), z AS (SELECT o.*, worst FROM {{f_ovl}} o LEFT JOIN w ON w.ovl_id = o.ovl_id) SELECT ovl_id, {set_bit('worst > 60', 'diff')} FROM z")
def _(v):
    return flags(O.segment_error(v("f_ovl"), v("f_trace"), 60))


@query("p11_trim_leading_indels", """r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY ovl_id ORDER BY seg) AS i, COUNT(*) OVER (PARTITION BY ovl_id) AS n FROM {f_trace}),
e AS (SELECT ovl_id, MAX(n) AS n, MAX(CASE WHEN i = 1 AND d >= a_to - a_from THEN a_to END) AS f_to, MAX(CASE WHEN i = 1 THEN blen END) AS f_b, MAX(CASE WHEN i = n AND d >= a_to - a_from THEN a_from END) AS l_from, MAX(CASE WHEN i = n THEN blen END) AS l_b FROM r GROUP BY 1)
SELECT o.ovl_id, CASE WHEN n > 2 THEN COALESCE(f_to, ab) ELSE ab END AS ab, CASE WHEN n > 2 THEN COALESCE(l_from, ae) ELSE ae END AS ae, CASE WHEN n > 2 AND f_to IS NOT NULL THEN bb + f_b ELSE bb END AS bb, CASE WHEN n > 2 AND l_from IS NOT NULL THEN be - l_b ELSE be END AS be FROM {f_ovl} o LEFT JOIN e ON e.ovl_id = o.ovl_id""")
def _(v):
    return O.trim_leading_indels(v("f_ovl"), v("f_trace"))


@query("p12_trim_overlaps", f"""{TRIMMED}, st AS (SELECT t.ovl_id, a_from, a_to, t.blen AS step, ta_b, ta_e, tb_b, tb_e, CAST(tr.bb + SUM(t.blen) OVER (PARTITION BY t.ovl_id ORDER BY seg ROWS UNBOUNDED PRECEDING) AS BIGINT) AS b_to FROM {{f_trace}} t JOIN tr ON tr.ovl_id = t.ovl_id),
cl AS (SELECT *, b_to - step AS b_from, GREATEST(a_from, ta_b, a_from + CAST(CEIL(GREATEST(0, tb_b - b_to + step) * (a_to - a_from) / step) AS BIGINT)) AS lo, LEAST(a_to, ta_e, a_to - CAST(CEIL(GREATEST(0, b_to - tb_e) * (a_to - a_from) / step) AS BIGINT)) AS hi FROM st WHERE step > 0),
c AS (SELECT ovl_id, MIN(lo) AS a1, MAX(hi) AS a2, MIN(GREATEST(b_from + CAST(FLOOR((lo - a_from) * step / (a_to - a_from)) AS BIGINT), tb_b)) AS b1, MAX(LEAST(b_from + CAST(FLOOR((hi - a_from) * step / (a_to - a_from)) AS BIGINT), tb_e)) AS b2 FROM cl WHERE hi > lo GROUP BY 1)
SELECT o.ovl_id, COALESCE(a1, ab) AS ab, COALESCE(a2, ae) AS ae, COALESCE(b1, bb) AS bb, COALESCE(b2, be) AS be, CASE WHEN a1 IS NULL THEN flags | {S.bit('trim') | 2} ELSE flags END AS flags FROM {{f_ovl}} o LEFT JOIN (SELECT * FROM c WHERE b2 > b1) c ON c.ovl_id = o.ovl_id""")
def _(v):
    return O.trim_overlaps(v("f_ovl"), v("f_trace"), trim(v))


@query("p13_downsample", "SELECT ovl_id, CASE WHEN GREATEST(aread, bread) * 100 > 60 * (SELECT COUNT(*) FROM {f_reads}) THEN flags | 2 ELSE flags END AS flags FROM {f_ovl}")
def _(v):
    return flags(O.downsample(v("f_ovl"), v("f_reads").count(), 60))


@query("p14_symmetric_discard", f"l AS (SELECT DISTINCT LEAST(aread, bread) AS lo, GREATEST(aread, bread) AS hi FROM {{f_ovl}} WHERE diffs > 1000), z AS (SELECT o.*, lo FROM {{f_ovl}} o LEFT JOIN l ON lo = LEAST(aread, bread) AND hi = GREATEST(aread, bread)) SELECT ovl_id, {set_bit('lo IS NOT NULL', 'symdiscard')} FROM z")
def _(v):
    o = v("f_ovl")
    return flags(O.symmetric_discard(o, o.where("diffs > 1000")))


@query("p15_exclude_include", "SELECT ovl_id FROM {f_ovl} o WHERE aread NOT IN (SELECT rid FROM {f_reads} WHERE best = 0) AND bread NOT IN (SELECT rid FROM {f_reads} WHERE best = 0) AND (aread IN (SELECT rid FROM {f_reads} WHERE rlen > 9000) OR bread IN (SELECT rid FROM {f_reads} WHERE rlen > 9000))")
def _(v):
    r = v("f_reads")
    return O.exclude_include(v("f_ovl"), exclude=r.where("best = 0").select("rid"), include=r.where("rlen > 9000").select("rid")).select("ovl_id")


@query("p16_identity_filters", "SELECT ovl_id, aread, bread FROM {f_ovl} WHERE aread = bread")
def _(v):
    return v("f_ovl").where("aread = bread").select("ovl_id", "aread", "bread")


STITCHED = "k AS (SELECT *, flags & 1 AS comp FROM {f_ovl} WHERE (flags & 2) = 0), l AS (SELECT *, ab - LAG(ae) OVER w AS da, bb - LAG(be) OVER w AS db FROM k WINDOW w AS (PARTITION BY aread, bread, comp ORDER BY ab, ae, bb, be, ovl_id)), sx AS (SELECT DISTINCT ovl_id FROM l WHERE ABS(da) < 2000 AND ABS(db) < 2000 AND ABS(da - db) < 1500)"


@query("p16_flagged_identity_filters", f"{STITCHED} SELECT ovl_id, aread, bread FROM {{f_ovl}} WHERE aread <> bread AND ovl_id NOT IN (SELECT ovl_id FROM sx)")
def _(v):
    """Without self overlaps and those that a stitch has taken in."""
    from pyspark.sql import Window as W

    w = W.partitionBy("aread", "bread", O.comp()).orderBy("ab", "ae", "bb", "be", "ovl_id")
    da, db = F.col("ab") - F.lag("ae").over(w), F.col("bb") - F.lag("be").over(w)
    near = (F.abs(da) < 2000) & (F.abs(db) < 2000) & (F.abs(da - db) < 1500)
    kept = O.purge(v("f_ovl")).withColumn("near", near).where("near").drop("near").select("ovl_id", F.lit(True).alias("taken"))
    o = v("f_ovl").join(kept, "ovl_id", "left").withColumn("flags", F.when(F.col("taken"), F.col("flags").bitwiseOR(F.lit(S.bit("stitch")))).otherwise(F.col("flags")))
    return O.identity_filters(o, stitched=True, own=True).select("ovl_id", "aread", "bread")


@query("o2_order_checks", "k AS (SELECT *, ROW(bread, flags & 1, ab, ae, bb, be, ovl_id) AS key FROM {f_ovl}), m AS (SELECT *, MAX(key) OVER (PARTITION BY aread ORDER BY ovl_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM k) SELECT aread, COUNT(*) AS late FROM m WHERE before > key GROUP BY 1")
def _(v):
    """Where the id order isn't the sort order."""
    return O.out_of_order(v("f_ovl"), "ovl_id").groupBy("aread").agg(F.count("*").alias("late"))


@query("o3_concatenate_split", "SELECT CAST(aread % 8 AS INT) AS part, COUNT(*) AS n, COUNT(DISTINCT aread) AS reads FROM {f_ovl} GROUP BY 1")
def _(v):
    o = v("f_ovl")
    whole = o.where(O.discarded()).unionByName(o.where(~O.discarded()))
    return O.split_parts(whole, 8).groupBy("part").agg(F.count("*").alias("n"), F.count_distinct("aread").alias("reads"))


@query("o5_take_n", "SELECT aread, COUNT(*) AS n, CAST(SUM(ae - ab) AS BIGINT) AS bases FROM {f_ovl} WHERE aread IN (SELECT DISTINCT aread FROM {f_ovl} ORDER BY aread LIMIT 100) GROUP BY 1")
def _(v):
    return O.first_reads(v("f_ovl"), 100).groupBy("aread").agg(F.count("*").alias("n"), F.sum(O.a_len()).alias("bases"))


@query("o6_union_anti_semi", "SELECT rid, track, beg, fin FROM {f_track} t WHERE track IN ('repeats', 'dust') AND rid NOT IN (SELECT rid FROM {f_reads} WHERE best = 0) AND rid IN (SELECT aread FROM {f_ovl})")
def _(v):
    t = v("f_track")
    both = t.where("track = 'repeats'").unionByName(t.where("track = 'dust'"))
    return both.join(v("f_reads").where("best = 0").select("rid"), "rid", "left_anti").join(v("f_ovl").select(F.col("aread").alias("rid")), "rid", "left_semi").select("rid", "track", "beg", "fin")


@query("overlap_scan", "SELECT aread, COUNT(*) AS n, MAX(ae - ab) AS longest, COUNT(DISTINCT bread) AS partners FROM {f_ovl} GROUP BY 1")
def _(v):
    """A user's function of the A reads' overlaps, those of many reads in a frame."""
    import pandas as pd

    def function(rows: pd.DataFrame) -> pd.DataFrame:
        reads = rows.assign(span=rows["ae"] - rows["ab"]).groupby("aread", sort=False)
        return reads.agg(n=("span", "size"), longest=("span", "max"), partners=("bread", "nunique")).reset_index()

    return O.overlap_scan(v("f_ovl").select("aread", "bread", "ab", "ae"), function, "aread long, n long, longest long, partners long")


@query("p17_extract_by_aread", "SELECT ovl_id, aread FROM {f_ovl} WHERE aread IN (SELECT rid FROM {f_reads} WHERE best = 0)")
def _(v):
    return O.extract_by_aread(v("f_ovl"), v("f_reads").where("best = 0")).select("ovl_id", "aread")


@query("p18_mito_filter", """k AS (SELECT *, ae - ab AS span FROM {f_ovl} WHERE (flags & 2) = 0 AND aread <> bread AND blen BETWEEN 3000 AND 12000),
s AS (SELECT *, CASE WHEN ab < LAG(ab) OVER w THEN 1 ELSE 0 END AS wrap, COALESCE(ab < LAG(ab) OVER w OR ABS(ab - LAG(ae) OVER w) <= 2000, TRUE) AS near FROM k WINDOW w AS (PARTITION BY aread, bread ORDER BY bb, be, ovl_id))
SELECT aread, bread, COUNT(*) AS n, CAST(SUM(span) AS BIGINT) AS covered FROM s GROUP BY 1, 2 HAVING COUNT(DISTINCT flags & 1) = 1 AND SUM(wrap) <= 1 AND BOOL_AND(near) AND SUM(span) * 100 >= MAX(blen) * 20""")
def _(v):
    return O.mito_filter(v("f_ovl"), shortest=3000, longest=12000, gap=2000, percent=20)


@query("j9_overlap_to_attributes", f"{TRIMMED} SELECT ovl_id, ta_b, ta_e, tb_b, tb_e FROM tr")
def _(v):
    return O.with_trim(v("f_ovl"), trim(v)).select("ovl_id", "ta_b", "ta_e", "tb_b", "tb_e")


PROJECT = """tk AS (SELECT rid, beg AS tb, fin AS tf FROM {f_track} WHERE track = 'repeats'), st AS (SELECT *, SUM(blen) OVER (PARTITION BY ovl_id ORDER BY seg ROWS UNBOUNDED PRECEDING) AS b_after FROM {f_trace}),
m AS (SELECT st.*, tb, tf, GREATEST(a_from, tb) AS lo, LEAST(a_to, tf) AS hi FROM st JOIN tk ON rid = aread AND tb < a_to AND a_from < tf AND tf > tb),
p AS (SELECT ovl_id, bread, tb, tf, MIN(b_after - blen + FLOOR((lo - a_from) * blen / (a_to - a_from))) AS p, MAX(b_after - blen + FLOOR((hi - a_from) * blen / (a_to - a_from))) AS q FROM m GROUP BY 1, 2, 3, 4)"""


@query("j11_project_interval_via_trace", f"{PROJECT} SELECT p.ovl_id, p.bread, tb AS beg, tf AS fin, CAST(bb + p AS BIGINT) AS b_beg, CAST(bb + q AS BIGINT) AS b_fin FROM p JOIN {{f_ovl}} o ON o.ovl_id = p.ovl_id")
def _(v):
    return O.project(v("f_ovl"), v("f_trace"), v("f_track").where("track = 'repeats'").select("rid", "beg", "fin"))


@query("j12_containment_semi", f"{TRIMMED} SELECT DISTINCT aread AS rid FROM tr WHERE aread <> bread AND ab <= ta_b AND ae >= ta_e")
def _(v):
    return O.contained_reads(v("f_ovl"), trim(v))


@query("j13_id_generation_map", "m AS (SELECT rid, ROW_NUMBER() OVER (PARTITION BY best ORDER BY rid) - 1 AS new_id FROM {f_reads}) SELECT ovl_id, a.new_id AS a_new, b.new_id AS b_new FROM {f_ovl} JOIN m a ON a.rid = aread JOIN m b ON b.rid = bread")
def _(v):
    from overlace.operators.sequences import renumbered

    m = renumbered(v("f_reads"), "best")
    a, b = m.select(F.col("rid").alias("aread"), F.col("new_id").alias("a_new")), m.select(F.col("rid").alias("bread"), F.col("new_id").alias("b_new"))
    return v("f_ovl").join(a, "aread").join(b, "bread").select("ovl_id", "a_new", "b_new")


def _contain(both: bool) -> str:
    comp = "AND (x.flags & 1) = (y.flags & 1)" if both else ""
    a, b = "x.ab >= y.ab AND x.ae <= y.ae", "x.bb >= y.bb AND x.be <= y.be"
    size = "(x.ae - x.ab + x.be - x.bb < y.ae - y.ab + y.be - y.bb OR x.ovl_id > y.ovl_id)"
    rule = f"{a} AND {b} AND {size}" if both else f"(({a}) OR ({b}))"
    return f"SELECT DISTINCT x.ovl_id, x.aread, x.bread FROM {{f_ovl}} x JOIN {{f_ovl}} y ON x.aread = y.aread AND x.bread = y.bread AND x.ovl_id <> y.ovl_id AND (x.flags & 2) = 0 AND (y.flags & 2) = 0 {comp} AND {rule}"


@query("w11_drop_containments", f"c AS ({_contain(True)}), z AS (SELECT o.*, c.ovl_id AS cid FROM {{f_ovl}} o LEFT JOIN c ON c.ovl_id = o.ovl_id) SELECT ovl_id, {set_bit('cid IS NOT NULL', 'cont')} FROM z")
def _(v):
    return flags(O.drop_containments(v("f_ovl")))


@query("w17_worst_alignments", f"""{TRIMMED}, k AS (SELECT *, ae - ab AS size, diffs / (ae - ab) AS err, CASE WHEN ab <= ta_b THEN 1 ELSE 0 END AS l, CASE WHEN ae >= ta_e THEN 1 ELSE 0 END AS r FROM tr WHERE (flags & 2) = 0 AND aread <> bread),
g AS (SELECT *, SUM(size) OVER w AS gs, SUM(size) OVER (PARTITION BY aread) AS ts, SUM(l) OVER (PARTITION BY aread) - SUM(l) OVER w AS ll, SUM(r) OVER (PARTITION BY aread) - SUM(r) OVER w AS rl FROM k WINDOW w AS (PARTITION BY aread ORDER BY err DESC, ovl_id ROWS UNBOUNDED PRECEDING)),
f AS (SELECT *, MAX(CASE WHEN gs * 100 > ts * 20 OR (l = 1 AND ll < 3) OR (r = 1 AND rl < 3) THEN 1 ELSE 0 END) OVER (PARTITION BY aread ORDER BY err DESC, ovl_id ROWS UNBOUNDED PRECEDING) AS fail FROM g)
SELECT aread, ovl_id FROM f WHERE fail = 0""")
def _(v):
    return O.worst_alignments(v("f_ovl"), trim(v), percent=20)


@query("w18_multi_mapper", f"SELECT DISTINCT aread, bread FROM ({_contain(False)}) c")
def _(v):
    return O.multi_mappers(v("f_ovl"))


@query("w19_contained_pairs", f"SELECT ovl_id FROM ({_contain(True)}) c")
def _(v):
    return O.containments(v("f_ovl"))


@query("w20_proper_pair_only", f"""{TRIMMED}, p AS (SELECT *, (ab - ta_b <= 500 OR bb - tb_b <= 500) AND (ta_e - ae <= 500 OR tb_e - be <= 500) AS pr FROM tr),
c AS (SELECT *, SUM(CASE WHEN pr THEN 1 ELSE 0 END) OVER (PARTITION BY aread, bread) AS np, COUNT(*) OVER (PARTITION BY aread, bread) AS n FROM p) SELECT ovl_id, CASE WHEN np = 1 AND n > 1 AND NOT pr THEN flags | 2 ELSE flags END AS flags FROM c""")
def _(v):
    return flags(O.proper_pair_only(v("f_ovl"), trim(v), 500))


@query("o1_sort_overlaps", "SELECT ovl_id, ROW_NUMBER() OVER (PARTITION BY aread ORDER BY bread, flags & 1, ab, ae, bb, be, ovl_id) AS place FROM {f_ovl}")
def _(v):
    from pyspark.sql import Window as W

    s = O.sorted_overlaps(v("f_ovl")).withColumn("comp", O.comp().cast("int"))
    return s.select("ovl_id", F.row_number().over(W.partitionBy("aread").orderBy("bread", *O.ORDER)).cast("long").alias("place"))


@query("o2_merge_sorted", "SELECT ovl_id, aread, bread, ab FROM {f_ovl}")
def _(v):
    o = v("f_ovl")
    return O.sorted_overlaps(o.where("ovl_id % 2 = 0").unionByName(o.where("ovl_id % 2 = 1"))).select("ovl_id", "aread", "bread", "ab")


@query("o4_topk_per_group", "SELECT aread, ovl_id, diffs FROM (SELECT aread, ovl_id, diffs, ROW_NUMBER() OVER (PARTITION BY aread ORDER BY diffs, ovl_id) AS k FROM {f_ovl}) WHERE k <= 20")
def _(v):
    from pyspark.sql import Window as W

    return v("f_ovl").withColumn("k", F.row_number().over(W.partitionBy("aread").orderBy("diffs", "ovl_id"))).where("k <= 20").select("aread", "ovl_id", "diffs")


@query("o7_quality_checks", "b AS (SELECT COUNT(*) FILTER (NOT (ab >= 0 AND ab < ae AND ae <= alen AND bb >= 0 AND bb < be AND be <= blen)) AS out_of_bounds, COUNT(*) AS overlaps FROM {f_ovl}), d AS (SELECT CAST(SUM(n - 1) AS BIGINT) AS duplicates FROM (SELECT COUNT(*) AS n FROM {f_ovl} GROUP BY aread, bread, flags & 1, ab, ae, bb, be)) SELECT * FROM b, d")
def _(v):
    return O.quality_checks(v("f_ovl"))


@query("s7_scan_overlaps", "SELECT aread, COUNT(*) AS n, CAST(SUM(ae - ab) AS BIGINT) AS bases FROM {f_ovl} GROUP BY 1")
def _(v):
    return v("f_ovl").groupBy("aread").agg(F.count("*").alias("n"), F.sum(F.col("ae") - F.col("ab")).alias("bases"))


@query("f5_identity", "SELECT ovl_id, 100.0 - 100.0 * diffs / (ae - ab) AS identity FROM {f_ovl}")
def _(v):
    return v("f_ovl").select("ovl_id", S.identity(F.col("diffs"), O.a_len()).alias("identity"))


@query("f6_divergence", "SELECT ovl_id, CAST(FLOOR(100.0 * 2 * diffs / (ae - ab + be - bb)) AS BIGINT) AS divergence FROM {f_ovl}")
def _(v):
    return v("f_ovl").select("ovl_id", S.divergence(F.col("diffs"), O.a_len(), O.b_len()).alias("divergence"))


@query("f7_flags_to_text", "SELECT ovl_id, CASE WHEN (flags & 1) = 1 THEN 'C' ELSE '' END || CASE WHEN (flags & 2) = 2 THEN 'D' ELSE '' END AS letters FROM {f_ovl}")
def _(v):
    return v("f_ovl").select("ovl_id", S.flags_to_text(F.col("flags")).alias("letters"))


@query("k3_show_overlaps", "SELECT ovl_id, aread, bread, CASE WHEN (flags & 1) = 1 THEN 'c' ELSE 'n' END AS strand, ab, ae, bb, be, diffs FROM {f_ovl} WHERE aread <> bread AND ae - ab >= 2000 AND 100.0 * diffs / (ae - ab) <= 15")
def _(v):
    o = v("f_ovl").where((F.col("aread") != F.col("bread")) & (O.a_len() >= 2000) & (100.0 * F.col("diffs") / O.a_len() <= 15))
    return o.select("ovl_id", "aread", "bread", F.when(O.comp(), "c").otherwise("n").alias("strand"), "ab", "ae", "bb", "be", "diffs")

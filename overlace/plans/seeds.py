"""Queries of k-mers, seeds and low complexity."""

from __future__ import annotations

from pyspark.sql import functions as F

from overlace.operators import seeds as K
from overlace.operators import traces as T
from overlace.operators.storage import stored
from overlace.plans.intervals import merged
from overlace.plans.registry import query


def km(k: int, name: str = "km", source: str = "{f_seq}") -> str:
    return f"{name} AS (SELECT rid, pos, substring(seq, pos + 1, {k}) AS kmer FROM (SELECT rid, seq, UNNEST(RANGE(0, length(seq) - {k} + 1)) AS pos FROM {source} WHERE length(seq) >= {k}))"


COUNTS = f"{km(8)}, kc AS (SELECT kmer, LEAST(COUNT(*), 255) AS n FROM km GROUP BY 1)"


@query("a10_kmer_counts", f"{COUNTS} SELECT kmer, n FROM kc")
def _(v):
    return K.kmer_counts(v("f_seq"), 8)


@query("a11_kmer_histogram", f"{COUNTS} SELECT n, COUNT(*) AS kmers FROM kc WHERE n < 255 GROUP BY 1")
def _(v):
    return K.kmer_histogram(K.kmer_counts(v("f_seq"), 8))


@query("a12_kmer_cutoffs", f"{COUNTS}, p AS (SELECT n, COUNT(*) AS k FROM kc GROUP BY 1), t AS (SELECT n, SUM(k) OVER (ORDER BY n DESC ROWS UNBOUNDED PRECEDING) AS top, SUM(k) OVER () AS total FROM p) SELECT MAX(n) AS over, CAST(FLOOR(1000000 / POWER(4, 8) * 10 * POWER(0.85, 8)) AS BIGINT) AS noise FROM t WHERE top >= CEIL(total * 0.01)")
def _(v):
    return K.kmer_cutoffs(K.kmer_counts(v("f_seq"), 8))


@query("a13_kmer_suppression", f"{km(12)}, c AS (SELECT kmer, COUNT(*) AS n FROM km GROUP BY 1) SELECT rid, COUNT(*) AS kept FROM km JOIN c ON c.kmer = km.kmer WHERE n <= 20 GROUP BY 1")
def _(v):
    return K.frequent_removed(v("f_seq"), 12, 20).groupBy("rid").agg(F.count("*").alias("kept"))


PAIRS = f"""tu AS (SELECT rid, reverse(translate(seq, 'acgt', 'tgca')) AS seq FROM {{f_seq}}), {km(16)}, {km(16, 'kt', 'tu')},
ok AS (SELECT kmer FROM (SELECT kmer FROM km UNION ALL SELECT kmer FROM kt) u GROUP BY 1 HAVING COUNT(*) <= 10), ka AS (SELECT * FROM km WHERE kmer IN (SELECT kmer FROM ok)),
kb AS (SELECT *, 0 AS comp FROM ka UNION ALL SELECT *, 1 FROM kt WHERE kmer IN (SELECT kmer FROM ok))"""
PR = f"{PAIRS}, pr AS (SELECT a.rid AS aread, b.rid AS bread, a.pos AS apos, b.pos AS bpos, comp FROM ka a JOIN kb b ON a.kmer = b.kmer WHERE b.rid < a.rid)"


@query("j1_kmer_seed_join", f"{PR} SELECT aread, bread, comp, COUNT(*) AS hits FROM pr GROUP BY 1, 2, 3")
def _(v):
    return K.seed_runs(v("f_seq"), 16).groupBy("aread", "bread", "comp").agg(F.sum("n").alias("hits"))


@query("j2_self_rules", f"{PAIRS} SELECT a.rid AS aread, comp, COUNT(*) AS hits FROM ka a JOIN kb b ON a.kmer = b.kmer WHERE b.rid < a.rid OR (b.rid = a.rid AND (b.pos < a.pos OR (comp = 1 AND b.pos = a.pos))) GROUP BY 1, 2")
def _(v):
    return K.seed_runs(v("f_seq"), 16, identity=True).groupBy("aread", "comp").agg(F.sum("n").alias("hits"))


@query("j3_both_strands", "SELECT rid, 0 AS comp, seq FROM {f_seq} UNION ALL SELECT rid, 1, reverse(translate(seq, 'acgt', 'tgca')) FROM {f_seq}")
def _(v):
    from overlace.functions.scalar import reverse_complement

    s = v("f_seq")
    return s.select("rid", F.lit(0).alias("comp"), "seq").unionByName(s.select("rid", F.lit(1).alias("comp"), reverse_complement(F.col("seq")).alias("seq")))


BANDS = f"""{PR}, pn AS (SELECT *, CAST(FLOOR(apos / 50000) AS BIGINT) AS panel FROM pr UNION ALL SELECT *, CAST(FLOOR(apos / 50000) AS BIGINT) - 1 FROM pr WHERE apos >= 50000 AND apos % 50000 < 10000),
pd AS (SELECT *, CAST(FLOOR((apos - bpos) / 64) AS BIGINT) AS band FROM pn),
fr AS (SELECT *, LEAST(16, COALESCE(apos - LAG(apos) OVER (PARTITION BY aread, bread, comp, panel, band ORDER BY apos, bpos), 16)) AS fresh FROM pd),
pe AS (SELECT aread, bread, comp, panel, band, SUM(fresh) AS own, MIN(apos) AS a1, MAX(apos) + 16 AS a2, MIN(bpos) AS b1, MAX(bpos) + 16 AS b2 FROM fr GROUP BY 1, 2, 3, 4, 5),
bn AS (SELECT *, CAST(own + CASE WHEN LEAD(band) OVER w = band + 1 THEN LEAD(own) OVER w ELSE 0 END AS BIGINT) AS bases FROM pe WINDOW w AS (PARTITION BY aread, bread, comp, panel ORDER BY band))"""


def _bands(v):
    return K.bands_of(v("f_seq"), 16)


@query("j5_diagonal_band_filter", f"{BANDS} SELECT aread, bread, comp, panel, band, a1, a2, b1, b2, bases FROM bn WHERE bases >= 35")
def _(v):
    return _bands(v)


@query("j4_symmetric_emit", f"{BANDS}, k AS (SELECT * FROM bn WHERE bases >= 35) SELECT aread, bread, comp, a1, a2, b1, b2 FROM k UNION ALL SELECT bread, aread, comp, b1, b2, a1, a2 FROM k")
def _(v):
    names = ["aread", "bread", "comp", "a1", "a2", "b1", "b2"]
    way = lambda *cols: F.struct(*[F.col(c).alias(name) for c, name in zip(cols, names, strict=True)])
    both = F.array(way(*names), way("bread", "aread", "comp", "b1", "b2", "a1", "a2"))
    return _bands(v).select(F.explode(both).alias("x")).select("x.*")


@query("j6_align_candidates", f"""{BANDS}, cn AS (SELECT *, UNNEST(RANGE(CAST(FLOOR(a1 / 100) AS BIGINT), CAST(FLOOR((a2 - 1) / 100) AS BIGINT) + 1)) AS seg FROM bn WHERE bases >= 35 AND a2 - a1 + b2 - b1 >= 200),
cx AS (SELECT *, GREATEST(a1, seg * 100) AS lo, LEAST(a2, seg * 100 + 100) AS hi FROM cn), cb AS (SELECT *, CAST(b1 + FLOOR((lo - a1) * (b2 - b1) / (a2 - a1)) AS BIGINT) AS p, CAST(b1 + FLOOR((hi - a1) * (b2 - b1) / (a2 - a1)) AS BIGINT) AS q FROM cx)
SELECT aread, bread, CAST(comp AS INT) AS comp, a1, a2, b1, b2, CAST(SUM(levenshtein(substring(a.seq, lo + 1, hi - lo), substring(CASE WHEN comp = 1 THEN t.seq ELSE b.seq END, p + 1, q - p))) AS BIGINT) AS diffs, COUNT(*) AS segs
FROM cb JOIN {{f_seq}} a ON a.rid = aread JOIN {{f_seq}} b ON b.rid = bread JOIN tu t ON t.rid = bread GROUP BY aread, bread, comp, panel, band, a1, a2, b1, b2""")
def _(v):
    return K.candidates(_bands(v), v("f_seq")).withColumn("segs", F.size("segments").cast("long")).drop("segments")


@query("j7_redundancy_removal", f"""{BANDS}, u AS (SELECT DISTINCT aread, bread, comp, a1, a2, b1, b2 FROM bn WHERE bases >= 35)
SELECT * FROM u x WHERE NOT EXISTS (SELECT 1 FROM u y WHERE x.aread = y.aread AND x.bread = y.bread AND x.comp = y.comp AND x.a1 >= y.a1 AND x.a2 <= y.a2 AND x.b1 >= y.b1 AND x.b2 <= y.b2 AND (x.a1 <> y.a1 OR x.a2 <> y.a2 OR x.b1 <> y.b1 OR x.b2 <> y.b2))""")
def _(v):
    return K.without_redundant(_bands(v).select("aread", "bread", "comp", "a1", "a2", "b1", "b2"))


def alignments(seqs, *, k: int = 16, both: bool = False):
    """J1 to J6: seeds, bands and chained alignments of all reads; the seeds are dealt out once, by pair. ``both``: of a pair either read is A, too."""
    found = T.chained_reads(seqs, k)
    return T.aligned(T.both_ways(stored(found), seqs) if both else found, seqs)


def _alignments(v):
    return alignments(v("f_seq"))


@query("a13_budget_cut", f"{km(12)}, n AS (SELECT COUNT(*) AS n FROM km WHERE regexp_full_match(kmer, '[acgt]+') GROUP BY kmer), h AS (SELECT n, SUM(COUNT(*) * n * (n - 1) / 2) OVER (ORDER BY n) AS upto FROM n GROUP BY n) SELECT CAST(COALESCE(MAX(n) FILTER (upto <= 1000000), 0) AS BIGINT) AS most, CAST(COALESCE(MAX(upto) FILTER (upto <= 1000000), 0) AS BIGINT) AS pairs, CAST(MIN(upto) FILTER (upto > 1000000) AS BIGINT) AS next_pairs FROM h")
def _(v):
    """The frequency cut that keeps matched pairs of 12-mers within a budget."""
    return K.budget_cut(K.code_counts(v("f_seq"), 12), 1_000_000)


@query("w6_perfect_intervals")
def _(v):
    return K.dust_perfect(v("f_seq"))


@query("j6_chained_alignments")
def _(v):
    return _alignments(v).withColumn("segs", F.size("trace").cast("long")).drop("trace")


@query("j7_fused_alignments")
def _(v):
    return T.fused(_alignments(v)).withColumn("segs", F.size("trace").cast("long")).drop("trace")


@query("c5_stitch_realigned")
def _(v):
    """J6, J7 and C5 in a row: fused alignments stitched where they nearly meet, seams aligned anew, with the trace's own sums beside."""
    seqs = v("f_seq")
    ovl, trace = T.as_overlaps(stored(T.fused(_alignments(v))), seqs)
    ovl, trace = T.stitched(ovl, trace, seqs, fuzz=100, low=K.dust(seqs))
    sums = trace.groupBy("ovl_id").agg(F.sum("blen").alias("b_bases"), F.sum("d").alias("edits"), F.count("*").alias("segs"))
    return ovl.join(sums, "ovl_id").select("ovl_id", "aread", "bread", "flags", "ab", "ae", "bb", "be", "diffs", "b_bases", "edits", "segs")


@query("j8_tandem_self_join", f"{km(12)}, t AS (SELECT rid, pos, pos - LAG(pos) OVER (PARTITION BY rid, kmer ORDER BY pos) AS period FROM km) SELECT rid, COUNT(*) AS hits, MIN(period) AS shortest FROM t WHERE period <= 200 GROUP BY 1")
def _(v):
    return K.tandem_hits(v("f_seq"), 12).groupBy("rid").agg(F.count("*").alias("hits"), F.min("period").alias("shortest"))


LOOK = f"{km(8)}, kn AS (SELECT kmer, COUNT(*) AS n FROM km GROUP BY 1), lk AS (SELECT rid, pos, n FROM km JOIN kn ON kn.kmer = km.kmer)"


@query("j14_kmer_lookup", f"{LOOK} SELECT rid, CAST(SUM(n) AS BIGINT) AS total, MAX(n) AS most FROM lk GROUP BY 1")
def _(v):
    return K.kmer_lookup(v("f_seq"), 8).groupBy("rid").agg(F.sum("n").alias("total"), F.max("n").alias("most"))


@query("w7_kmer_window_class", f"{LOOK}, p AS (SELECT rid, CAST(FLOOR(pos / 251) AS BIGINT) AS w, COUNT(*) AS c, COUNT(*) FILTER (n < 20) AS low, COUNT(*) FILTER (n >= 200) AS high FROM lk GROUP BY 1, 2), k AS (SELECT rid, w * 251 AS beg, (w + 1) * 251 AS fin, CASE WHEN high > 0.5 * (c - low) THEN 'krepeats' WHEN low * 2 > c THEN 'knoise' END AS track FROM p) SELECT * FROM k WHERE track IS NOT NULL")
def _(v):
    return K.window_classes(K.kmer_lookup(v("f_seq"), 8), noise=20, over=200)


@query("w6_dust_mask", f"""{km(3)}, pp AS (SELECT a.rid, a.pos AS p, b.pos AS q FROM km a JOIN km b ON a.rid = b.rid AND a.kmer = b.kmer AND b.pos > a.pos AND b.pos - a.pos <= 61),
ev AS (SELECT rid, GREATEST(q - 61, 0) AS pos, 1 AS delta FROM pp UNION ALL SELECT rid, p + 1, -1 FROM pp), es AS (SELECT rid, pos, SUM(delta) AS delta FROM ev GROUP BY 1, 2),
cs AS (SELECT rid, pos, SUM(delta) OVER (PARTITION BY rid ORDER BY pos ROWS UNBOUNDED PRECEDING) AS pairs, COALESCE(LEAD(pos) OVER (PARTITION BY rid ORDER BY pos), pos + 1) AS nx FROM es),
hi AS (SELECT c.rid, pos AS beg, LEAST(nx, length(seq) - 63) - 1 + 64 AS fin FROM cs c JOIN {{f_seq}} s ON s.rid = c.rid WHERE pairs > 2 * 61 AND pos <= length(seq) - 64), {merged('hi')} SELECT rid, beg, fin FROM mg""")
def _(v):
    return K.dust(v("f_seq"))


@query("f9_kmer_code", f"{km(8)} SELECT kmer, MAX(" + " + ".join(f"(strpos('acgt', substring(kmer, {i + 1}, 1)) - 1) * {4 ** (7 - i)}" for i in range(8)) + ") AS code FROM km GROUP BY 1")
def _(v):
    from overlace.functions.scalar import kmer_code

    return K.code_counts(v("f_seq"), 8).select(K.kmer_text(F.col("code"), 8).alias("kmer")).withColumn("code", kmer_code(F.col("kmer")))

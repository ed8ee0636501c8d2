"""Queries of sequences, text sources and text sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from overlace.functions import scalar as S
from overlace.operators import sequences as Q

from overlace.plans import intervals  # noqa: F401
from overlace.plans.registry import NESTED, query
from overlace.sources import sinks, text



def _records(v):
    """FASTA records as a reader that splits at ``>`` hands them over."""
    r = v("f_reads").join(v("f_seq"), "rid")
    name = F.concat(F.lit("m/"), F.col("well").cast("string"), F.lit("/"), F.col("tb").cast("string"), F.lit("_"), F.col("te").cast("string"))
    args = F.concat(F.lit(" RQ=0."), (F.col("rid") % 90 + 10).cast("string"), F.lit(" seqid="), F.col("rid").cast("string"), F.lit(","), F.col("well").cast("string"))
    return r.select(F.concat(name, args, F.lit("\n"), S.wrapped(F.col("seq"), 60), F.lit("\n")).alias("value"))


RECORDS = "rc AS (SELECT r.rid, well, tb, te, seq, 'm/' || CAST(well AS VARCHAR) || '/' || CAST(tb AS VARCHAR) || '_' || CAST(te AS VARCHAR) AS name FROM {f_reads} r JOIN {f_seq} s ON s.rid = r.rid)"


@query("s1_read_fasta", f"{RECORDS} SELECT name, seq FROM rc WHERE length(seq) >= 1000")
def _(v):
    return text.fasta_records(_records(v)).where(F.length("seq") >= 1000).select("name", "seq")


@query("s2_fasta_header_args", f"{RECORDS} SELECT name, 'RQ' AS track, 0 AS k, CAST(rid % 90 + 10 AS VARCHAR) AS value FROM rc UNION ALL SELECT name, 'seqid', 0, CAST(rid AS VARCHAR) FROM rc UNION ALL SELECT name, 'seqid', 1, CAST(well AS VARCHAR) FROM rc")
def _(v):
    return text.header_args(text.fasta_records(_records(v)), ["RQ", "seqid"])


@query("s3_parse_well_header", f"{RECORDS} SELECT name, well, tb AS beg, te AS fin FROM rc")
def _(v):
    return text.well_header(text.fasta_records(_records(v)))


# Runs of "tt" stand for runs of N, so that the sequences at hand have some.
@query("s5_split_scaffolds", r"""s AS (SELECT rid, replace(seq, 'tt', 'nn') AS seq FROM {f_seq}), p AS (SELECT rid, UNNEST(regexp_extract_all(seq, '[^n]+|n+')) AS part, UNNEST(RANGE(1, len(regexp_extract_all(seq, '[^n]+|n+')) + 1)) AS k FROM s),
o AS (SELECT rid, k, part, length(part) AS len, SUM(length(part)) OVER (PARTITION BY rid ORDER BY k ROWS UNBOUNDED PRECEDING) - length(part) AS beg FROM p)
SELECT rid, ROW_NUMBER() OVER (PARTITION BY rid ORDER BY k) - 1 AS piece, CAST(beg AS BIGINT) AS beg, len FROM o WHERE part NOT LIKE 'n%'""")
def _(v):
    return Q.scaffold_pieces(v("f_seq").select("rid", F.replace("seq", F.lit("tt"), F.lit("nn")).alias("seq")))


@query("s6_base_composition", "SELECT base, CAST(SUM(length(regexp_replace(seq, '[^' || base || ']', '', 'g'))) AS BIGINT) AS n FROM {f_seq}, (SELECT UNNEST(['a', 'c', 'g', 't']) AS base) GROUP BY 1".replace("regexp_replace(seq, '[^' || base || ']', '', 'g')", "seq) - length(replace(seq, base, '')"))
def _(v):
    return Q.base_composition(v("f_seq"))


@query("s8_scan_tracks", "SELECT rid, beg, fin FROM {f_track} WHERE track = 'dust'")
def _(v):
    return v("f_track").where("track = 'dust'").select("rid", "beg", "fin")


@query("s9_text_to_track", "SELECT t.rid, beg, fin FROM {f_track} t JOIN {f_reads} r ON r.rid = t.rid WHERE fin > rlen - 100")
def _(v):
    lines = v("f_track").select(F.concat_ws(" ", F.col("rid").cast("string"), F.col("beg").cast("string"), F.col("fin").cast("string")).alias("value"))
    return text.out_of_bounds(text.track_lines(lines), v("f_reads").withColumn("rlen", F.col("rlen") - 100))


@query("s10_gff_to_track", "SELECT rid, beg, fin FROM {f_track} WHERE track = 'tan'")
def _(v):
    t = v("f_track").where("track = 'tan'")
    line = F.concat_ws("\t", F.concat(F.lit("read_"), F.col("rid").cast("string")), F.lit("x"), "track", (F.col("beg") + 1).cast("string"), F.col("fin").cast("string"), (F.col("fin") - F.col("beg")).cast("string"), F.lit("+"), F.lit("."))
    return text.gff_lines(t.select(line.alias("value")))


@query("s11_read_id_lists", "SELECT DISTINCT r.rid FROM {f_reads} r JOIN {f_reads} x ON r.rid BETWEEN x.rid AND x.rid + 3 WHERE x.tb < 60")
def _(v):
    lines = v("f_reads").where("tb < 60").select(F.concat(F.col("rid").cast("string"), F.lit("-"), (F.col("rid") + 3).cast("string")).alias("value"))
    return text.id_ranges(lines, v("f_reads"))


@query("s14_tgf_graph", "SELECT src, dst, side || ':' || CAST(ovh AS VARCHAR) || ':' || CAST(div AS VARCHAR) AS label FROM {f_graph}")
def _(v):
    return text.tgf_edges(sinks.graph_lines(v("f_graph")))


@query("s15_path_lines", "p AS (SELECT well AS path, ROW_NUMBER() OVER (PARTITION BY well ORDER BY rid) - 1 AS pos, rid, LEAD(rid) OVER (PARTITION BY well ORDER BY rid) AS nx, MIN(rid) OVER (PARTITION BY well) AS end1, MAX(rid) OVER (PARTITION BY well) AS end2 FROM {f_reads}) SELECT path, end1, end2, CAST(pos AS INT) AS pos, rid AS src, nx AS dst FROM p WHERE nx IS NOT NULL")
def _(v):
    return text.path_lines(sinks.path_lines(_well_paths(v)).select("value"))


def _well_paths(v):
    from pyspark.sql import Window as W

    return v("f_reads").select(F.col("well").alias("path"), (F.row_number().over(W.partitionBy("well").orderBy("rid")) - 1).alias("pos"), "rid")


@query("k7_write_paths", "p AS (SELECT well AS path, rid, LEAD(rid) OVER (PARTITION BY well ORDER BY rid) AS nx FROM {f_reads}) SELECT path, 'PATH ' || CAST(path AS VARCHAR) || ' ' || CAST(MIN(rid) AS VARCHAR) || ' ' || CAST(MAX(rid) AS VARCHAR) || ' ' || COALESCE(string_agg(CAST(rid AS VARCHAR) || '-' || CAST(nx AS VARCHAR), ' ' ORDER BY rid), '') AS value FROM p GROUP BY 1")
def _(v):
    return sinks.path_lines(_well_paths(v))


@query("k1_write_fasta", "t AS (SELECT rid, ' ' || track || '=' || string_agg(CAST(beg AS VARCHAR) || ',' || CAST(fin AS VARCHAR), ',' ORDER BY beg, fin) AS a FROM {f_track} GROUP BY rid, track), x AS (SELECT rid, string_agg(a, '' ORDER BY a) AS args FROM t GROUP BY 1) SELECT s.rid, '>read_' || CAST(s.rid AS VARCHAR) || COALESCE(args, '') || chr(10) || regexp_replace(upper(seq), '(.{80})', '\\1' || chr(10), 'g') AS value FROM {f_seq} s LEFT JOIN x ON x.rid = s.rid".replace("regexp_replace(upper(seq), '(.{80})', '\\1' || chr(10), 'g')", "rtrim(regexp_replace(upper(seq), '(.{80})', '\\1' || chr(10), 'g'), chr(10))").replace("(.{80})", "(................................................................................)"))
def _(v):
    return sinks.fasta_lines(v("f_seq"), v("f_track"), upper=True)


@query("k2_show_reads", "SELECT s.rid, substring(seq, tb + 1, te - tb) AS seq FROM {f_seq} s JOIN {f_reads} r ON r.rid = s.rid WHERE te - tb >= 3000")
def _(v):
    r = v("f_seq").join(v("f_reads").select("rid", "tb", "te"), "rid").where("te - tb >= 3000")
    return r.select("rid", F.substring("seq", (F.col("tb") + 1).cast("int"), (F.col("te") - F.col("tb")).cast("int")).alias("seq"))


@query("k4_show_track", "SELECT concat_ws(chr(9), 'read_' || CAST(rid AS VARCHAR), CAST(beg AS VARCHAR), CAST(fin AS VARCHAR), track) AS value FROM {f_track}")
def _(v):
    return sinks.bed_lines(v("f_track"))


@query("k5_write_track", "SELECT track, COUNT(*) AS n, MIN(rid) AS low, MAX(rid) AS high FROM {f_track} GROUP BY 1")
def _(v):
    from overlace.operators.storage import stored

    return stored(v("f_track").repartition("track").sortWithinPartitions("rid", "beg")).groupBy("track").agg(F.count("*").alias("n"), F.min("rid").alias("low"), F.max("rid").alias("high"))


@query("k6_write_graph", "SELECT CAST(src AS VARCHAR) || ' ' || CAST(dst AS VARCHAR) || ' ' || side || ':' || CAST(ovh AS VARCHAR) || ':' || CAST(div AS VARCHAR) AS value FROM {f_graph}")
def _(v):
    return sinks.graph_lines(v("f_graph"))


@query("k8_write_read_lists", "SELECT DISTINCT LEAST(aread, bread) AS lo, GREATEST(aread, bread) AS hi FROM {f_ovl} WHERE (flags & 2) = 2")
def _(v):
    from overlace.operators.overlaps import discarded

    return v("f_ovl").where(discarded()).select(F.least("aread", "bread").alias("lo"), F.greatest("aread", "bread").alias("hi")).distinct()


@query("k8_read_lists", f"""{NESTED['p19_spanning_repeats']}, {NESTED['w14_chimer_walls']}, {NESTED['w10_gap_bins']}, {NESTED['w13_tip_coverage']}
SELECT DISTINCT 'spanning' AS kind, rid FROM p19_spanning_repeats UNION SELECT 'chimer', rid FROM w14_chimer_walls UNION SELECT 'gap', rid FROM w10_gap_bins UNION SELECT 'low', rid FROM w13_tip_coverage WHERE bad""")
def _(v):
    """Reads that span a repeat, that have chimeric walls, a gap, or too little coverage at a tip."""
    from overlace.operators import coverage as C

    t = v("f_track").where("track = 'repeats'").join(v("f_reads").select("rid", "tb", "te"), "rid")
    lists = {
        "spanning": t.where("beg - tb >= 300 and te - fin >= 300"), "chimer": C.walls(v("f_ovl")), "gap": C.breaks(v("f_ovl")),
        "low": C.tip_coverage(v("f_ovl"), v("f_reads").select("rid", "tb", "te")).where("bad"),
    }
    out = None
    for kind, df in lists.items():
        one = df.select(F.lit(kind).alias("kind"), "rid").distinct()
        out = one if out is None else out.unionByName(one)
    return out


@query("w22_lowercase_tips", "d AS (SELECT doc_id AS rid, regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g') AS seq FROM {documents}) SELECT rid, regexp_replace(regexp_replace(seq, '^[a-z]+', ''), '[a-z]+$', '') AS trimmed, regexp_full_match(seq, '[a-z]*') AS garbage FROM d")
def _(v):
    return Q.lower_case_tips(v("documents").select(F.col("doc_id").alias("rid"), F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", "").alias("seq")))


@query("w23_split_long_reads", """n AS (SELECT rid, length(seq) AS len, CASE WHEN length(seq) <= 1000 THEN 1 ELSE CAST(CEIL((length(seq) - 100) / 900) AS BIGINT) END AS c FROM {f_seq}), k AS (SELECT rid, len, c, UNNEST(RANGE(0, c)) AS chunk FROM n), r AS (SELECT *, len - (c - 1) * 900 AS rest FROM k),
s AS (SELECT *, c > 1 AND rest < 500 AS sh, CAST(FLOOR((1000 + rest - 100) / 2) AS BIGINT) AS half FROM r)
SELECT rid, CAST(chunk AS INT) AS chunk, CASE WHEN sh AND chunk = c - 1 THEN (c - 2) * 900 + half - 100 ELSE chunk * 900 END AS beg, CASE WHEN chunk = c - 1 THEN len WHEN sh AND chunk = c - 2 THEN chunk * 900 + half ELSE LEAST(chunk * 900 + 1000, len) END AS fin FROM s""")
def _(v):
    return Q.split_long(v("f_seq"), 1000, 100)


@query("w24_restriction_sites", "p AS (SELECT rid, seq, UNNEST(RANGE(0, length(seq) - 5)) AS pos FROM {f_seq} WHERE length(seq) >= 6) SELECT rid, pos + 1 AS pos FROM p WHERE substring(seq, pos + 1, 6) = 'agatct' UNION ALL SELECT rid, length(seq) FROM {f_seq}")
def _(v):
    return Q.restriction_sites(v("f_seq"), "agatct")


@query("f1_revcomp", "SELECT rid, reverse(translate(seq, 'acgt', 'tgca')) AS rc, reverse(seq) AS rev FROM {f_seq}")
def _(v):
    return v("f_seq").select("rid", S.reverse_complement(F.col("seq")).alias("rc"), F.reverse("seq").alias("rev"))


@query("f2_case_and_width", "SELECT rid, length(regexp_replace(upper(seq), '(..........)', '\\1' || chr(10), 'g')) - CASE WHEN length(seq) > 0 AND length(seq) % 10 = 0 THEN 1 ELSE 0 END AS n FROM {f_seq}")
def _(v):
    return v("f_seq").select("rid", F.length(S.wrapped(F.upper("seq"), 10)).cast("long").alias("n"))


@query("f3_parse_bp", "SELECT rid, rlen * 1000 AS bases, CAST(rlen AS VARCHAR) || 'k' AS shown FROM {f_reads}".replace("CAST(rlen AS VARCHAR) || 'k'", "CAST(CAST(FLOOR(rlen * 1000 / 1000000) AS BIGINT) AS VARCHAR) || 'm'"))
def _(v):
    b = S.parse_bp(F.concat(F.col("rlen").cast("string"), F.lit("k")))
    return v("f_reads").select("rid", b.alias("bases"), S.format_bp(b).alias("shown"))




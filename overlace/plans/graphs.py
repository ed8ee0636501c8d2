"""Queries of the overlap graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from overlace.operators import graph as G
from overlace.operators import tours
from overlace.plans.overlaps import TRIMMED, trim
from overlace.plans.registry import query


@query("g1_drop_parallel", "SELECT ovl_id, aread, bread FROM (SELECT *, COUNT(*) OVER (PARTITION BY aread, bread) AS n FROM {f_ovl} WHERE (flags & 2) = 0) t WHERE n = 1")
def _(v):
    return G.drop_parallel(v("f_ovl")).select("ovl_id", "aread", "bread")


EDGES = f"""{TRIMMED}, k AS (SELECT *, flags & 1 AS c, CAST(FLOOR(100.0 * 2 * diffs / (ae - ab + be - bb)) AS BIGINT) AS div FROM tr WHERE (flags & 2) = 0 AND aread <> bread),
h AS (SELECT *, 'l' AS side, 'r' AS other, bb - tb_b AS ovh, ta_e - ae AS back FROM k WHERE ab = ta_b UNION ALL SELECT *, 'r', 'l', tb_e - be, ab - ta_b FROM k WHERE ae = ta_e),
ed AS (SELECT ovl_id, aread AS src, bread AS dst, side, ovh, c, div FROM h WHERE ovh > 0 UNION ALL SELECT ovl_id, bread, aread, CASE WHEN c = 1 THEN side ELSE other END, back, c, div FROM h WHERE ovh > 0 AND back > 0)"""


@query("g3_make_edges", f"{EDGES} SELECT ovl_id, src, dst, side, ovh, div FROM ed")
def _(v):
    return G.edges(v("f_ovl"), trim(v)).select("ovl_id", "src", "dst", "side", "ovh", "div")


@query("g2_classify_reads", f"""{EDGES}, ns AS (SELECT *, ab <= ta_b AND ae >= ta_e AS ai, bb <= tb_b AND be >= tb_e AS bi FROM tr WHERE aread <> bread),
ct AS (SELECT aread AS rid FROM ns WHERE ai UNION SELECT bread FROM ns WHERE bi AND NOT ai), ln AS (SELECT src AS rid FROM ed UNION SELECT dst FROM ed)
SELECT rid, CASE WHEN rid IN (SELECT rid FROM ct) THEN 'contained' WHEN rid IN (SELECT rid FROM ln) THEN 'proper' ELSE 'widow' END AS kind FROM {{f_reads}}""")
def _(v):
    return G.classify(v("f_ovl"), trim(v))


UNIQUE = "un AS (SELECT src, dst, side, ovh, div FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY src, dst, side ORDER BY ovh DESC, div DESC) AS k FROM {f_graph}) t WHERE k = 1), dd AS (SELECT * FROM un u WHERE side = 'l' OR NOT EXISTS (SELECT 1 FROM un x WHERE x.src = u.src AND x.dst = u.dst AND x.side = 'l'))"


@query("g4_remove_dupes", f"{UNIQUE} SELECT src, dst, side, ovh, div FROM dd")
def _(v):
    return G.remove_duplicates(v("f_graph"))


@query("g5_add_contained", f"""{UNIQUE}, e0 AS (SELECT * FROM dd WHERE dst % 5 <> 0 AND src % 5 <> 0), u0 AS (SELECT src AS rid FROM e0 UNION SELECT dst FROM e0), s0 AS (SELECT rid, side FROM u0, (SELECT 'l' AS side UNION ALL SELECT 'r') x WHERE NOT EXISTS (SELECT 1 FROM e0 WHERE e0.src = rid AND e0.side = x.side)),
n1 AS (SELECT src, dst, side, ovh, div FROM (SELECT d.*, ROW_NUMBER() OVER (PARTITION BY d.src, d.side ORDER BY ovh DESC, dst) AS k FROM dd d JOIN s0 ON s0.rid = d.src AND s0.side = d.side WHERE dst % 5 = 0) t WHERE k = 1)
SELECT src, dst, side, ovh, div, 0 AS optional FROM e0 UNION ALL SELECT src, dst, side, ovh, div, 1 FROM n1""")
def _(v):
    e = G.remove_duplicates(v("f_graph"))
    kinds = v("f_reads").select("rid", F.when(F.col("rid") % 5 == 0, "contained").otherwise("proper").alias("kind"))
    return G.add_contained(e.where("dst % 5 != 0 and src % 5 != 0"), kinds, e.where("dst % 5 = 0"), rounds=1)


@query("g5_add_contained_until_stable")
def _(v):
    """With the kinds of G2, until a round adds nothing."""
    kinds, e = G.stored(G.classify(v("f_ovl"), trim(v))), G.stored(G.remove_duplicates(v("f_graph")))
    inside = kinds.where("kind = 'contained'").select("rid")
    proper = e.join(inside.withColumnRenamed("rid", "src"), "src", "left_anti").join(inside.withColumnRenamed("rid", "dst"), "dst", "left_anti")
    return G.add_contained(proper.select(*e.columns), kinds, e.join(inside.withColumnRenamed("rid", "dst"), "dst", "left_semi").select(*e.columns))


@query("g6_components_all")
@query("g6_components", "b AS (SELECT src, dst FROM {f_graph} UNION SELECT dst, src FROM {f_graph}), r(rid, low) AS (SELECT src, src FROM b UNION SELECT b.dst, r.low FROM r JOIN b ON b.src = r.rid) SELECT rid, MIN(low) AS component FROM r GROUP BY 1")
def _(v):
    return G.components(v("f_graph"))


@query("g7_neighborhood", """e AS (SELECT DISTINCT src, dst FROM {f_graph}), s AS (SELECT DISTINCT rid FROM {f_reads} WHERE tb = 0), h1 AS (SELECT DISTINCT dst AS rid FROM e JOIN s ON s.rid = src WHERE dst NOT IN (SELECT rid FROM s)),
h2 AS (SELECT DISTINCT dst AS rid FROM e JOIN h1 ON h1.rid = src WHERE dst NOT IN (SELECT rid FROM s) AND dst NOT IN (SELECT rid FROM h1)) SELECT rid, 0 AS hop FROM s UNION ALL SELECT rid, 1 FROM h1 UNION ALL SELECT rid, 2 FROM h2""")
def _(v):
    return G.neighbourhood(v("f_graph"), v("f_reads").where("tb = 0"), 2)


@query("g8_dead_ends", f"{UNIQUE}, n AS (SELECT src AS rid, COUNT(*) FILTER (side = 'l') AS l, COUNT(*) FILTER (side = 'r') AS r FROM dd GROUP BY 1) SELECT rid, CASE WHEN l = 0 THEN 'l' ELSE 'r' END AS open FROM n WHERE l = 0 OR r = 0")
def _(v):
    return G.dead_ends(G.remove_duplicates(v("f_graph")))


@query("g9_drop_inversions", "t AS (SELECT src, dst FROM {f_graph} GROUP BY 1, 2 HAVING COUNT(DISTINCT side) > 1) SELECT g.src, g.dst, side, ovh, div FROM {f_graph} g WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.src = g.src AND t.dst = g.dst)")
def _(v):
    return G.drop_inversions(v("f_graph"))


@query("g10_vertex_quality", """n AS (SELECT src AS rid, COUNT(*) FILTER (side = 'l') AS l, COUNT(*) FILTER (side = 'r') AS r, AVG(div) AS d FROM {f_graph} GROUP BY 1)
SELECT rid, ROUND(CASE WHEN l = 0 THEN 1.0 ELSE 1 / LEAST(10, l) END + CASE WHEN r = 0 THEN 1.0 ELSE 1 / LEAST(10, r) END + d / 1000, 9) AS quality FROM n""")
def _(v):
    return G.vertex_quality(v("f_graph"))


LOOKAHEAD = 6
_steps = ", ".join(
    f"w{d} AS (SELECT rid, w.side, s.dst AS v, MIN(first) AS first, {d} AS depth, SUM(n) AS n FROM w{d - 1} w JOIN st s ON s.src = w.v AND s.side = w.side WHERE s.dst <> rid GROUP BY 1, 2, 3)" for d in range(2, LOOKAHEAD + 1)
)
_all = " UNION ALL ".join(f"SELECT * FROM w{d}" for d in range(1, LOOKAHEAD + 1))
NEXT = f"""st AS (SELECT DISTINCT src, side, dst FROM {{f_graph}}), w1 AS (SELECT src AS rid, side, dst AS v, dst AS first, 1 AS depth, 1 AS n FROM st), {_steps},
vi AS (SELECT rid, side, v, SUM(n) AS n, MIN(depth * 10000000000 + first) % 10000000000 AS first FROM ({_all}) al GROUP BY 1, 2, 3),
nx AS (SELECT rid, side, CAST(first AS BIGINT) AS next FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY rid, side ORDER BY n DESC, v) AS k FROM vi) t WHERE k = 1)"""


@query("g11_best_next", f"{NEXT} SELECT rid, side, next FROM nx")
def _(v):
    return G.best_next(v("f_graph"))


def _paths(v):
    return G.unitigs(G.best_next(v("f_graph")))


@query("g12_backbone_paths")
def _(v):
    return _paths(v)


@query("g12_claimed_backbones")
def _(v):
    """Paths of the overlaps' own edges that claim vertices by the quality of their starts, with the path that each end meets."""
    edges = G.edges(v("f_ovl"), trim(v)).select("src", "dst", "side", "ovh", "c", "div")
    return tours.backbones(G.remove_duplicates(edges))


@query("g13_path_joins")
def _(v):
    return G.path_joins(G.stored(_paths(v)), v("f_graph"))


@query("g13_joined_paths")
def _(v):
    return G.joined_paths(G.stored(_paths(v)), v("f_graph"))


@query("g12_end_labels")
def _(v):
    chosen = G.stored(G.best_next(v("f_graph")))
    return G.end_labels(G.stored(G.unitigs(chosen)), chosen)


@query("g14_path_sequences")
def _(v):
    """Sequences of the unitigs of the overlaps' own edges, whose strands turn the reads along a path."""
    edges = G.stored(G.edges(v("f_ovl"), trim(v)))
    plain = G.remove_duplicates(edges.select("src", "dst", "side", "ovh", "div"))
    return G.path_sequences(G.stored(G.unitigs(G.best_next(plain))), v("f_seq"), edges)


@query("g15_path_reads", f"{NEXT} SELECT DISTINCT rid FROM nx")
def _(v):
    return _paths(v).select("rid").distinct()


@query("j16_pairs_of_paths")
def _(v):
    return G.sharing_paths(G.stored(_paths(v)), v("f_graph"), more_than=2)

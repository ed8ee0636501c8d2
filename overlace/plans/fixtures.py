"""Views over the given tables that carry the schemas of reads, overlaps, traces and tracks.

Each view is one SQL text per engine; names in braces are other views or given tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS = {
    "f_reads": """
SELECT p_partkey AS rid, 3000 + (p_partkey * 7919) % 12000 AS rlen, CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE 1 END AS best,
       CAST(FLOOR(p_partkey / 3) AS BIGINT) AS well, (p_partkey * 37) % 300 AS tb, 3000 + (p_partkey * 7919) % 12000 - (p_partkey * 41) % 300 AS te
FROM {part}""",
    "f_ovl": """
SELECT ovl_id, aread, bread, flags, ab, ab + len AS ae, bb, bb + len + CASE WHEN ovl_id % 19 = 0 AND bb + len < blen THEN 1 ELSE 0 END AS be,
       CAST(FLOOR(len * (ovl_id % 30) / 100) AS BIGINT) AS diffs, alen, blen
FROM (
  SELECT ovl_id, aread, bread, flags, ab, bb, alen, blen, LEAST(500 + (ovl_id * 31) % 5000, alen - ab, blen - bb) AS len
  FROM (
    SELECT l.ovl_id, l.aread, l.bread, l.flags, a.rlen AS alen, b.rlen AS blen,
           CASE WHEN l.ovl_id % 7 = 0 THEN a.tb ELSE (l.ovl_id * 131) % (a.rlen - 600) END AS ab,
           CASE WHEN l.ovl_id % 6 = 0 THEN b.tb ELSE (l.ovl_id * 53) % (b.rlen - 600) END AS bb
    FROM (
      SELECT DISTINCT (l_orderkey * 8 + l_linenumber) * (SELECT COUNT(*) FROM {part}) + l_partkey AS ovl_id, l_partkey AS aread,
             (l_orderkey * 13 + l_linenumber * 7) % (SELECT COUNT(*) FROM {part}) AS bread,
             l_linenumber % 2 + CASE WHEN l_orderkey % 17 = 0 THEN 2 ELSE 0 END AS flags
      FROM {lineitem}) l
    JOIN {f_reads} a ON a.rid = l.aread
    JOIN {f_reads} b ON b.rid = l.bread) s) t""",
    "f_trace": """
SELECT ovl_id, aread, bread, CAST(seg AS BIGINT) AS seg, GREATEST(ab, seg * 100) AS a_from, LEAST(ae, seg * 100 + 100) AS a_to,
       (ovl_id * 3 + seg * 5) % 40 AS d, LEAST(ae, seg * 100 + 100) - GREATEST(ab, seg * 100) AS blen
FROM (SELECT *, EXPLODE(SEQUENCE(CAST(FLOOR(ab / 100) AS BIGINT), CAST(FLOOR((ae - 1) / 100) AS BIGINT))) AS seg FROM {f_ovl}) u""",
    "f_track": """
SELECT rid, track, beg, LEAST(rlen, beg + 200 + (k * 11) % 1500) AS fin
FROM (
  SELECT r.rid, r.rlen, o.k, o.track, (o.k * 29) % r.rlen AS beg
  FROM (SELECT o_orderkey AS k, o_custkey % (SELECT COUNT(*) FROM {part}) AS rid,
               CASE WHEN o_orderkey % 3 = 0 THEN 'repeats' WHEN o_orderkey % 3 = 1 THEN 'dust' ELSE 'tan' END AS track
        FROM {orders}) o
  JOIN {f_reads} r ON r.rid = o.rid) s""",
    "f_seq": """
SELECT doc_id AS rid, TRANSLATE(REGEXP_REPLACE(LOWER(text), '[^a-z]', ''), 'abcdefghijklmnopqrstuvwxyz', 'acgtacgtacgtacgtacgtacgtac') AS seq
FROM {documents}""",
    "f_q": """
SELECT rid, CAST(seg AS BIGINT) AS seg, (rid * 7 + seg * 13 + CAST(FLOOR(seg / 9) AS BIGINT) * 17) % 45 AS q
FROM (SELECT rid, EXPLODE(SEQUENCE(CAST(0 AS BIGINT), CAST(FLOOR(rlen / 100) AS BIGINT) - 1)) AS seg FROM {f_reads}) u""",
    "f_subreads": """
SELECT l_orderkey AS well, l_linenumber AS frag, (l_partkey * 17) % 4000 AS ins_beg,
       (l_partkey * 17) % 4000 + 200 + (l_suppkey * 131 + l_orderkey * 7) % 6000 AS ins_end, 500 AS hq_beg, 8000 AS hq_end,
       CAST(l_quantity AS DOUBLE) AS avg_qv, (l_orderkey * 3 + l_linenumber * 11) % 150 AS slow_bases
FROM (SELECT l_orderkey, l_linenumber, MIN(l_partkey) AS l_partkey, MIN(l_suppkey) AS l_suppkey, MIN(l_quantity) AS l_quantity
      FROM {lineitem} GROUP BY l_orderkey, l_linenumber) u""",
    "f_sam": """
SELECT l_orderkey AS qname, l_linenumber AS mate,
       CASE WHEN l_orderkey % 23 = 0 THEN 4 ELSE 0 END + CASE WHEN l_linenumber % 2 = 0 THEN 16 ELSE 0 END AS flag,
       l_suppkey AS rname, (l_partkey * 997) % 50000 + 1 AS pos, l_partkey % 61 AS mapq,
       CASE WHEN l_partkey % 4 = 0 THEN '100M' WHEN l_partkey % 4 = 1 THEN '60M40S' WHEN l_partkey % 4 = 2 THEN '40S60M' ELSE '20S60M20S' END AS cigar
FROM (SELECT l_orderkey, l_linenumber, MIN(l_partkey) AS l_partkey, MIN(l_suppkey) AS l_suppkey
      FROM {lineitem} WHERE l_linenumber <= 2 GROUP BY l_orderkey, l_linenumber) u""",
    "f_graph": """
SELECT DISTINCT aread AS src, bread AS dst, CASE WHEN ovl_id % 2 = 0 THEN 'l' ELSE 'r' END AS side, 1 + ovl_id % 997 AS ovh, ovl_id % 40 AS div
FROM {f_ovl} o JOIN {f_reads} a ON a.rid = o.aread WHERE aread <> bread AND ab = tb""",
}
#: Where DuckDB says the same differently.
DUCKDB = {
    "EXPLODE(SEQUENCE(CAST(FLOOR(ab / 100) AS BIGINT), CAST(FLOOR((ae - 1) / 100) AS BIGINT)))": "UNNEST(RANGE(CAST(FLOOR(ab / 100) AS BIGINT), CAST(FLOOR((ae - 1) / 100) AS BIGINT) + 1))",
    "EXPLODE(SEQUENCE(CAST(0 AS BIGINT), CAST(FLOOR(rlen / 100) AS BIGINT) - 1))": "UNNEST(RANGE(0, CAST(FLOOR(rlen / 100) AS BIGINT)))",
    "REGEXP_REPLACE(LOWER(text), '[^a-z]', '')": "REGEXP_REPLACE(LOWER(text), '[^a-z]', '', 'g')",
}


#: Overlaps in one part of the dealt-out overlaps; each has some 25 segments.
PART = 100_000


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or a view over them."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    needs = {n: view(spark, sf_dir, n) for n in set(re.findall(r"\{(\w+)\}", VIEWS[name]))}
    if name == "f_trace":
        needs["f_ovl"] = _dealt(needs["f_ovl"], view(spark, sf_dir, "lineitem").count())
    return spark.sql(VIEWS[name], **needs)


def _dealt(ovl: DataFrame, rows: int) -> DataFrame:
    """Overlaps dealt by A read before they are spread to segments: what then groups segments by A read and more moves
    none of them, and joins on A read and more move the other side only."""
    spark = ovl.sparkSession
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return ovl.repartition(max(1, -(-rows // PART), min(most, rows // 5_000)), "aread")


def duckdb_sql(text: str) -> str:
    """``text`` with a WITH clause for the views that it names in braces.

    ``text`` may begin with common table expressions of its own (``name AS (...), ... SELECT``).
    """
    order: list[str] = []

    def need(part: str) -> None:
        for name in re.findall(r"\{(\w+)\}", part):
            if name in VIEWS and name not in order:
                need(VIEWS[name])
                order.append(name)

    need(text)
    views = []
    for name in order:
        body = VIEWS[name]
        for spark_text, duck in DUCKDB.items():
            body = body.replace(spark_text, duck)
        views.append(f"{name} AS ({body})")
    text = text.strip()
    starts = re.match(r"(?i)select\b", text)
    whole = f"WITH RECURSIVE {', '.join(views)}" + (" " if starts else ", ") + text if views else (text if starts else f"WITH {text}")
    return re.sub(r"\{(\w+)\}", r"\1", whole)

"""Queries of the live masks: overlaps are written as files and read as a stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from overlace.operators.storage import stored
from overlace.plans.intervals import hysteresis, merged
from overlace.plans.registry import query
from overlace.streaming import masks as M


#: Overlaps in a file, about; a trigger takes as many files as make a block.
FILE = 500_000


def written(ovl: DataFrame, folder: str, blocks: int, rows: int) -> int:
    """Append ``ovl`` (of about ``rows`` rows) to ``folder``, dealt to ``blocks`` blocks of equally many files; how many files make a block."""
    files = max(1, -(-rows // (blocks * FILE)))
    ovl.repartition(blocks * files, "ovl_id").write.mode("append").parquet(folder)
    return files


def _blocks(v):
    """f_ovl stored, its number of rows, and a folder for a stream of its blocks and for results."""
    o = stored(v("f_ovl"))
    return o, o.count(), f"{o.sparkSession.conf.get('spark.checkpoint.dir').rstrip('/')}/overlace-stream-{uuid.uuid4().hex}"


def _stream(v):
    """f_ovl as eight blocks of files, some overlaps a second time, and a folder for results."""
    o, rows, root = _blocks(v)
    files = written(o, f"{root}/blocks", 8, rows)
    written(o.where("ovl_id % 8 = 0"), f"{root}/blocks", 1, rows // 8)
    return o.sparkSession, M.ingest(o.sparkSession, f"{root}/blocks", o.schema, files=files), root


def _hits(v, ends=0):
    spark, stream, root = _stream(v)
    M.accumulate(stream, f"{root}/hits", f"{root}/state", ends=ends)
    return M.read_hits(spark, f"{root}/hits")


HITS = "h AS (SELECT aread AS rid, bread, GREATEST(ab, ENDS) AS beg, LEAST(ae, alen - ENDS) AS fin FROM {f_ovl} WHERE (flags & 2) = 0 AND aread <> bread AND LEAST(ae, alen - ENDS) > GREATEST(ab, ENDS))"
MASK = f"{merged('h', 'rid, bread', name='m1')}, ev AS (SELECT rid, beg AS pos, 1 AS delta FROM m1 UNION ALL SELECT rid, fin, -1 FROM m1), cv AS (SELECT rid, pos, delta, SUM(delta) OVER (PARTITION BY rid ORDER BY pos, delta ROWS UNBOUNDED PRECEDING) AS cov FROM ev), {hysteresis('cv', '10', '11')}"


@query("t1_ingest_blocks", f"{HITS.replace('ENDS', '0')}, {merged('h', 'rid, bread', name='m1')} SELECT rid, COUNT(*) AS n, CAST(SUM(fin - beg) AS BIGINT) AS bases FROM m1 GROUP BY 1")
def _(v):
    from overlace.operators import intervals as I  # noqa: E741

    return I.merge(_hits(v), ["rid", "bread"]).groupBy("rid").agg(F.count("*").alias("n"), F.sum(F.col("fin") - F.col("beg")).alias("bases"))


@query("t3_accumulate_coverage", f"{HITS.replace('ENDS', '0')} SELECT rid, COUNT(*) AS n, CAST(SUM(fin - beg) AS BIGINT) AS bases FROM h GROUP BY 1")
def _(v):
    spark, stream, root = _stream(v)
    done = M.running_totals(stream, f"{root}/totals", f"{root}/state")
    return spark.read.parquet(f"{root}/totals/{done.lastProgress['batchId']}")


@query("t4_emit_masks", f"{HITS.replace('ENDS', '0')}, {MASK}, {merged('hy')} SELECT rid, beg, fin FROM mg")
def _(v):
    return M.masks(_hits(v), above=10)


@query("t4_live_masks", f"""{HITS.replace('ENDS', '0')}, {MASK}, {merged('hy')}, ct AS (SELECT aread AS rid, MAX(alen) AS alen FROM {{f_ovl}} WHERE (flags & 2) = 0 AND aread <> bread AND ab = 0 AND ae = alen AND (blen > alen OR (blen = alen AND bread < aread)) GROUP BY 1)
SELECT rid, 'maskr' AS track, beg, fin FROM mg UNION ALL SELECT rid, 'maskc', 0, alen FROM ct""")
def _(v):
    """T3 and T4 as state by read: the masks of a read are written anew only by batches that have hits of it."""
    o, rows, root = _blocks(v)
    spark = o.sparkSession
    files = written(o, f"{root}/blocks", 8, rows)
    stream = spark.readStream.schema(o.schema).option("maxFilesPerTrigger", 2 * files).parquet(f"{root}/blocks")
    M.live_masks(stream, f"{root}/masks", f"{root}/state", above=10)
    return M.read_masks(spark, f"{root}/masks")


@query("t5_ends_unmasked", f"{HITS.replace('ENDS', '700')}, {MASK}, {merged('hy')} SELECT rid, beg, fin FROM mg")
def _(v):
    return M.masks(_hits(v, ends=700), above=10)


@query("t7_initialise_from_dust", f"{HITS.replace('ENDS', '0')}, {MASK}, al AS (SELECT rid, beg, fin FROM hy UNION ALL SELECT rid, beg, fin FROM {{f_track}} WHERE track = 'dust'), {merged('al')} SELECT rid, beg, fin FROM mg")
def _(v):
    return M.masks(_hits(v), above=10, dust=v("f_track").where("track = 'dust'"))


@query("t2_merge_multi_hits", f"{HITS.replace('ENDS', '0')}, {merged('h', 'rid, bread', name='m1')} SELECT rid, CAST(SUM(n - 1) AS BIGINT) AS joined FROM m1 WHERE n > 1 GROUP BY 1")
def _(v):
    """Hits of one B read that touch on A count once: how many each read loses to that."""
    from overlace.operators import intervals as I  # noqa: E741

    return I.merge(M.hits(v("f_ovl")), ["rid", "bread"]).where("n > 1").groupBy("rid").agg(F.sum(F.col("n") - 1).alias("joined"))


@query("t6_checkpoint_resume", f"{HITS.replace('ENDS', '0')} SELECT rid, COUNT(*) AS n, CAST(SUM(fin - beg) AS BIGINT) AS bases FROM h GROUP BY 1")
def _(v):
    """The totals of a stream that stopped after half of the files and went on from its checkpoint."""
    o, rows, root = _blocks(v)
    spark = o.sparkSession
    for half in (0, 1):
        files = written(o.where(F.col("ovl_id") % 2 == half), f"{root}/blocks", 2, rows // 2)
        done = M.running_totals(M.ingest(spark, f"{root}/blocks", o.schema, files=files), f"{root}/totals", f"{root}/state")
    return spark.read.parquet(f"{root}/totals/{done.lastProgress['batchId']}")

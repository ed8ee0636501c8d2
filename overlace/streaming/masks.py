"""Live repeat masks: overlaps arrive as files, coverage accumulates, masks are read off.

Blocks have no event time, so there is no watermark; an overlap that arrives twice is
dropped by its id. A stream's progress lies in its checkpoint folder, so it resumes where
it stopped, and each batch writes a folder of its own, so a batch that is run again
replaces what it wrote.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from overlace.functions.scalar import has
from overlace.operators import intervals as I  # noqa: E741


def ingest(spark: SparkSession, folder: str, schema, *, files: int = 1) -> DataFrame:
    """Overlap files of a folder as a stream, ``files`` a trigger, each overlap once."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder).dropDuplicates(["ovl_id"])


def hits(ovl: DataFrame, *, ends: int = 0) -> DataFrame:
    """Kept, non-self overlaps as (rid, bread, beg, fin); ``ends`` bases at both read ends aren't counted."""
    kept = ovl.where(~has(F.col("flags"), "discard") & (F.col("aread") != F.col("bread")))
    clipped = kept.select(F.col("aread").alias("rid"), "bread", F.greatest("ab", F.lit(ends)).alias("beg"), F.least("ae", F.col("alen") - ends).alias("fin"))
    return clipped.where("fin > beg")


def accumulate(stream: DataFrame, table: str, checkpoint: str, *, ends: int = 0):
    """Append every batch's hits to ``table``, one folder per batch, until all files are read."""

    def put(batch: DataFrame, number: int) -> None:
        # Hits of one B read that touch count once: merged here for the batch, and again when read.
        merged = I.merge(hits(batch, ends=ends), ["rid", "bread"]).select("rid", "bread", "beg", "fin")
        merged.write.mode("overwrite").parquet(f"{table}/batch={number}")

    query = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def read_hits(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.parquet(table).select("rid", "bread", "beg", "fin")


def masks(found: DataFrame, *, above: int, dust: DataFrame | None = None) -> DataFrame:
    """(rid, beg, fin): where more than ``above`` B reads cover a read, with the dust track, if given, from the start."""
    one = I.merge(found, ["rid", "bread"])
    cov = I.hysteresis(I.sweep(one, ["rid"]), ["rid"], F.lit(above), F.lit(above + 1))
    both = cov.select("rid", "beg", "fin") if dust is None else cov.select("rid", "beg", "fin").unionByName(dust.select("rid", "beg", "fin"))
    return I.merge(both, ["rid"]).select("rid", "beg", "fin")


def running_totals(stream: DataFrame, table: str, checkpoint: str):
    """Per read the overlaps and bases so far, as state of a streaming aggregation; each batch replaces ``table``'s latest."""
    totals = hits(stream).groupBy("rid").agg(F.count("*").alias("n"), F.sum(F.col("fin") - F.col("beg")).alias("bases"))

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/{number}")

    query = totals.writeStream.outputMode("complete").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


# Masks from state by group of reads: a batch touches the groups that it has hits of, and writes those reads of them that it has hits of.


def united(*columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Intervals (B read, beg, fin) of each B read, or of each of more keys, those that overlap or touch joined; the same interval again changes nothing."""
    *keys, beg, fin = columns
    if not len(beg):
        return columns
    order = np.lexsort((beg, *keys[::-1]))
    keys, beg, fin = [k[order] for k in keys], beg[order], fin[order]
    rank = np.zeros(len(beg), np.int64)
    rank[1:] = np.cumsum(np.logical_or.reduce([np.diff(k) != 0 for k in keys]))
    far = rank * (1 << 40)  # keys lie apart on one line
    upto = np.maximum.accumulate(fin + far)
    new = np.ones(len(beg), bool)
    new[1:] = beg[1:] + far[1:] > upto[:-1]
    last = np.append(new[1:], True)
    return *(k[new] for k in keys), beg[new], (upto - far)[last]


def _above(beg: np.ndarray, fin: np.ndarray, above: int) -> tuple[np.ndarray, np.ndarray]:
    place, step = np.concatenate([beg, fin]), np.repeat([1, -1], [len(beg), len(fin)])
    at, inverse = np.unique(place, return_inverse=True)
    cov = np.cumsum(np.bincount(inverse, weights=step, minlength=len(at))).astype(np.int64)
    high = np.concatenate([[False], cov > above, [False]])
    return at[np.flatnonzero(high[1:-1] & ~high[:-2])], at[np.flatnonzero(~high[1:-1] & high[:-2])]


def covered_above(beg: np.ndarray, fin: np.ndarray, above: int) -> list[tuple[int, int]]:
    """Where more than ``above`` of the intervals lie over each other; stretches that touch are one."""
    return list(zip(*(x.tolist() for x in _above(beg, fin, above)), strict=True))


#: The state of a group of reads, as bytes of numbers: its joined hits, and its reads with their sizes and whether they are contained.
STATE = {"rid": np.int64, "bread": np.int64, "beg": np.int32, "fin": np.int32, "read": np.int64, "contained": np.int8, "size": np.int32}
MASKS = "rid long, track string, beg long, fin long"
#: Groups of reads, each with a state of its own.
GROUPS = 1024


def _read_masks_of(hits_: tuple, reads: tuple, touched: np.ndarray, above: int) -> pd.DataFrame:
    """The masks (``MASKS``) of the touched reads; a read without one says so, too."""
    mine = np.isin(hits_[0], touched)
    rid, beg, fin = hits_[0][mine], hits_[2][mine], hits_[3][mine]
    far = np.searchsorted(touched, rid) << 40  # reads lie apart on one line
    b, e = _above(beg + far, fin + far, above)
    of, full = touched[b >> 40], np.flatnonzero(np.isin(reads[0], touched) & (reads[1] > 0))
    none = touched[~np.isin(touched, np.concatenate([of, reads[0][full]]))]
    each = [(of, "maskr", b & (1 << 40) - 1, e & (1 << 40) - 1), (reads[0][full], "maskc", np.zeros(len(full), np.int64), reads[2][full]), (none, "none", *[np.zeros(len(none), np.int64)] * 2)]
    return pd.DataFrame({name: np.concatenate([np.full(len(x[0]), x[1], object) if i == 1 else x[i] for x in each]) for i, name in enumerate(("rid", "track", "beg", "fin"))})


def live_masks(stream: DataFrame, table: str, checkpoint: str, *, above: int, ends: int = 0):
    """Masks kept as state while overlap files arrive; each batch appends those of the reads it touched to ``table``.

    The state of a read is the hits of each B read, joined, so what arrives twice counts
    once, without a memory of ids; reads are dealt to ``GROUPS`` groups, and a task takes a group at a
    time. Tracks: ``maskr``, where more than ``above`` B reads
    cover it, and ``maskc``, the whole of a read that lies in a longer one (of equally
    long ones, in that of the smaller id). ``ends`` bases at both ends aren't counted.
    """
    kept = stream.where(~has(F.col("flags"), "discard") & (F.col("aread") != F.col("bread")))
    inside = (F.col("ab") == 0) & (F.col("ae") == F.col("alen")) & ((F.col("blen") > F.col("alen")) | ((F.col("blen") == F.col("alen")) & (F.col("bread") < F.col("aread"))))
    rows = kept.select(
        F.pmod(F.xxhash64("aread"), F.lit(GROUPS)).alias("part"), F.col("aread").alias("rid"), "bread", F.greatest("ab", F.lit(ends)).alias("beg"), F.least("ae", F.col("alen") - ends).alias("fin"), inside.alias("contained"), F.col("alen").alias("size")
    )

    def run(key, frames, state):
        old = [np.frombuffer(x, t).astype(np.int64) for x, t in zip(state.get, STATE.values(), strict=True)] if state.exists else [np.zeros(0, np.int64)] * len(STATE)
        new = pd.concat(list(frames))
        some = new[new["fin"] > new["beg"]]
        joined = united(*(np.concatenate([x, some[name].to_numpy(np.int64)]) for x, name in zip(old[:4], STATE, strict=False)))
        every = [np.concatenate([x, new[name].to_numpy(np.int64)]) for x, name in zip(old[4:], ("rid", "contained", "size"), strict=True)]
        read, of = np.unique(every[0], return_inverse=True)
        reads = (read, np.zeros(len(read), np.int64), np.zeros(len(read), np.int64))
        for held, x in zip(reads[1:], every[1:], strict=True):
            np.maximum.at(held, of, x)
        state.update(tuple(x.astype(t).tobytes() for x, t in zip((*joined, *reads), STATE.values(), strict=True)))
        yield _read_masks_of(joined, reads, np.unique(new["rid"].to_numpy(np.int64)), above)

    changed = rows.groupBy("part").applyInPandasWithState(run, MASKS, ", ".join(f"{name} binary" for name in STATE), "update", GroupStateTimeout.NoTimeout)

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={number}")

    query = changed.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def read_masks(spark: SparkSession, table: str) -> DataFrame:
    """(rid, track, beg, fin): of each read the masks of the last batch that touched it."""
    every = spark.read.schema(f"{MASKS}, batch long").parquet(table)
    last = every.groupBy("rid").agg(F.max("batch").alias("batch"))
    return every.join(last, ["rid", "batch"]).where("track != 'none'").select("rid", "track", "beg", "fin")

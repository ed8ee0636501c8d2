"""Reads as sequences: import and export formats, splitting, trimming, numbering."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def renumbered(reads: DataFrame, *by: str) -> DataFrame:
    """rid and its new number, counted from 0 within ``by`` in rid order."""
    return reads.select("rid", (F.row_number().over(W.partitionBy(*by).orderBy("rid")) - 1).cast("long").alias("new_id"))


def best_per_well(reads: DataFrame) -> DataFrame:
    """The longest read of each well, the smallest id of equals."""
    return reads.withColumn("_k", F.row_number().over(W.partitionBy("well").orderBy(F.desc("rlen"), "rid"))).where("_k = 1").drop("_k")


def scaffold_pieces(seqs: DataFrame) -> DataFrame:
    """(rid, piece, beg, len): the stretches of each sequence between runs of N, numbered from 0, with their offsets."""
    parts = seqs.select("rid", F.posexplode(F.split("seq", "(?<=[nN])(?=[^nN])|(?<=[^nN])(?=[nN])")).alias("k", "part"))
    w = W.partitionBy("rid").orderBy("k")
    placed = parts.withColumn("len", F.length("part").cast("long")).withColumn("beg", F.sum("len").over(w.rowsBetween(W.unboundedPreceding, 0)) - F.col("len"))
    solid = placed.where(~F.col("part").rlike("^[nN]*$"))
    return solid.select("rid", (F.row_number().over(w) - 1).cast("long").alias("piece"), "beg", "len")


def base_composition(seqs: DataFrame) -> DataFrame:
    """(base, n): how often each of a, c, g, t occurs; counted per read, then summed."""
    each = F.array(*(F.struct(F.lit(b).alias("base"), F.length(F.regexp_replace("seq", f"[^{b}]", "")).cast("long").alias("n")) for b in "acgt"))
    return seqs.select(F.explode(each).alias("x")).groupBy("x.base").agg(F.sum("x.n").alias("n"))


def lower_case_tips(seqs: DataFrame) -> DataFrame:
    """(rid, trimmed, garbage): lower-case prefix and suffix removed; all-lower sequences are garbage."""
    trimmed = F.regexp_replace(F.regexp_replace("seq", "^[a-z]+", ""), "[a-z]+$", "")
    return seqs.select("rid", trimmed.alias("trimmed"), F.col("seq").rlike("^[a-z]*$").alias("garbage"))


def split_long(seqs: DataFrame, most: int, overlap: int) -> DataFrame:
    """(rid, chunk, beg, fin): chunks of ``most`` bases that overlap by ``overlap``; the last two share what is left evenly when the rest is short."""
    step = most - overlap
    n = F.length("seq")
    count = F.when(n <= most, 1).otherwise(F.ceil((n - overlap) / step)).cast("int")
    c = seqs.select("rid", n.cast("long").alias("len"), count.alias("count"), F.explode(F.sequence(F.lit(0), count - 1)).alias("chunk"))
    beg = F.col("chunk").cast("long") * step
    rest = F.col("len") - (F.col("count") - 1) * step
    # A last chunk below half size takes half of what it and the one before hold together.
    short = (F.col("count") > 1) & (rest < most / 2)
    half = F.floor((most + rest - overlap) / 2).cast("long")
    before, last = F.col("chunk") == F.col("count") - 2, F.col("chunk") == F.col("count") - 1
    start = F.when(short & last, (F.col("count") - 2) * step + half - overlap).otherwise(beg)
    end = F.when(short & before, beg + half).otherwise(F.least(beg + most, "len"))
    return c.select("rid", "chunk", start.cast("long").alias("beg"), F.when(last, F.col("len")).otherwise(end).alias("fin"))


def restriction_sites(seqs: DataFrame, site: str) -> DataFrame:
    """(rid, pos): every place of the recognition sequence, from 1, and the length as the last place."""
    pattern = re.compile(f"(?={re.escape(site)})")

    def find(batches):
        for frame in batches:
            found = [(rid, m.start() + 1) for rid, seq in zip(frame["rid"], frame["seq"], strict=True) for m in pattern.finditer(seq or "")]
            yield pd.DataFrame(found, columns=["rid", "pos"])

    found = seqs.select("rid", "seq").mapInPandas(find, "rid long, pos long")
    return found.unionByName(seqs.select("rid", F.length("seq").cast("long").alias("pos")))

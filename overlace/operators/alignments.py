"""Short-read alignments as SAM rows: mates, five-prime filter, pair flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def mates(sam: DataFrame) -> DataFrame:
    """First and second mates side by side, joined on the read name: qname, struct a, struct b."""
    row = F.struct("flag", "rname", "pos", "mapq", "cigar")
    return sam.where("mate = 1").select("qname", row.alias("a")).join(sam.where("mate = 2").select("qname", row.alias("b")), "qname")


def five_prime(sam: DataFrame) -> DataFrame:
    """Per read name the 5'-aligned record where exactly one of at most two is, else the first, flagged unmapped: (qname, mate, flag, kept)."""
    reverse = F.col("flag").bitwiseAND(F.lit(16)) != 0
    five = F.when(~reverse, F.col("cigar").rlike("^[0-9]+M")).otherwise(F.col("cigar").rlike("[0-9]+M$")) & (F.col("flag").bitwiseAND(F.lit(4)) == 0)
    w = W.partitionBy("qname")
    s = sam.withColumn("five", five).withColumn("n", F.count("*").over(w)).withColumn("nf", F.count_if("five").over(w)).withColumn("k", F.row_number().over(w.orderBy(F.desc("five"), "mate")))
    kept = (F.col("nf") == 1) & (F.col("n") <= 2)
    return s.where("k = 1").select("qname", "mate", F.when(kept, F.col("flag")).otherwise(F.col("flag").bitwiseOR(F.lit(4))).alias("flag"), kept.alias("kept"))


def paired(sam: DataFrame, *, least: int) -> DataFrame:
    """Mapped pairs of mapping quality ``least`` or more with rebuilt flags and signed insert: (qname, flag1, flag2, insert)."""
    p = mates(sam).where((F.col("a.flag").bitwiseAND(F.lit(4)) == 0) & (F.col("b.flag").bitwiseAND(F.lit(4)) == 0) & (F.col("a.mapq") >= least) & (F.col("b.mapq") >= least))

    def flag(own, other, nth):
        back = F.when(F.col(f"{other}.flag").bitwiseAND(F.lit(16)) != 0, 32).otherwise(0)
        return F.col(f"{own}.flag").bitwiseAND(F.lit(16)).bitwiseOR(F.lit(1 | 2 | nth)).bitwiseOR(back)

    insert = F.when(F.col("a.rname") == F.col("b.rname"), F.col("b.pos") - F.col("a.pos")).otherwise(0)
    return p.select("qname", flag("a", "b", 64).alias("flag1"), flag("b", "a", 128).alias("flag2"), insert.alias("insert"))

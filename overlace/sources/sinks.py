"""Text forms of reads, tracks, graphs and paths, to be written with ``write.text`` or ``write.csv``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from overlace.functions.scalar import wrapped


def fasta_lines(reads: DataFrame, tracks: DataFrame | None = None, *, width: int = 80, upper: bool = False) -> DataFrame:
    """(rid, value): a FASTA record per read, its intervals as ``track=beg,end,...`` arguments."""
    out = reads
    args = F.lit("")
    if tracks is not None:
        one = tracks.groupBy("rid", "track").agg(F.array_sort(F.collect_list(F.struct("beg", "fin"))).alias("v"))
        text = F.concat(F.lit(" "), F.col("track"), F.lit("="), F.array_join(F.transform("v", lambda x: F.concat(x["beg"].cast("string"), F.lit(","), x["fin"].cast("string"))), ","))
        out = out.join(one.groupBy("rid").agg(F.array_join(F.array_sort(F.collect_list(text)), "").alias("args")), "rid", "left")
        args = F.coalesce("args", F.lit(""))
    seq = F.upper("seq") if upper else F.col("seq")
    return out.select("rid", F.concat(F.lit(">read_"), F.col("rid").cast("string"), args, F.lit("\n"), wrapped(seq, width)).alias("value"))


def bed_lines(track: DataFrame) -> DataFrame:
    return track.select(F.concat_ws("\t", F.concat(F.lit("read_"), F.col("rid").cast("string")), F.col("beg").cast("string"), F.col("fin").cast("string"), "track").alias("value"))


def graph_lines(edge: DataFrame) -> DataFrame:
    """TGF edge lines ``src dst side:ovh:div``."""
    return edge.select(F.concat_ws(" ", F.col("src").cast("string"), F.col("dst").cast("string"), F.concat_ws(":", "side", F.col("ovh").cast("string"), F.col("div").cast("string"))).alias("value"))


def path_lines(paths: DataFrame) -> DataFrame:
    """``PATH id first last v-w ...``: steps in order; a path of one vertex has none."""
    w = W.partitionBy("path").orderBy("pos")
    s = paths.withColumn("next", F.lead("rid").over(w)).withColumn("step", F.when(F.col("next").isNotNull(), F.concat_ws("-", F.col("rid").cast("string"), F.col("next").cast("string"))))
    whole = s.groupBy("path").agg(F.min_by("rid", "pos").alias("a"), F.max_by("rid", "pos").alias("b"), F.array_sort(F.collect_list(F.when(F.col("step").isNotNull(), F.struct("pos", "step")))).alias("v"))
    steps = F.transform("v", lambda x: x["step"])
    return whole.select("path", F.concat_ws(" ", F.lit("PATH"), F.col("path").cast("string"), F.col("a").cast("string"), F.col("b").cast("string"), F.array_join(steps, " ")).alias("value"))


def write_track(track: DataFrame, path: str) -> None:
    """Parquet, one folder per track, rows sorted by read so that row-group statistics prune."""
    track.repartition("track").sortWithinPartitions("track", "rid", "beg").write.partitionBy("track").parquet(path)

"""Text sources: FASTA, tracks, GFF, SAM, graphs, paths. Each reads a path that Spark can open."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_fasta(spark: SparkSession, path: str, *, shortest: int = 1000) -> DataFrame:
    """(name, header, seq) of FASTA records of at least ``shortest`` bases."""
    # A record begins at a > that begins a line; one inside a header is part of it.
    lines = spark.read.text(path, lineSep="\n>")
    records = lines.select(F.regexp_replace("value", "^>", "").alias("value")).where(F.trim("value") != "")
    return fasta_records(records).where(F.length("seq") >= shortest)


def fasta_records(records: DataFrame) -> DataFrame:
    """Records (value: first line, sequence lines) as name, header, seq."""
    header = F.trim(F.split_part("value", F.lit("\n"), F.lit(1)))
    body = F.regexp_replace(F.substring("value", F.instr("value", "\n") + 1, F.length("value")), r"\s", "")
    return records.select(F.split_part(header, F.lit(" "), F.lit(1)).alias("name"), header.alias("header"), F.when(F.instr("value", "\n") > 0, body).otherwise("").alias("seq"))


def header_args(records: DataFrame, names: list[str]) -> DataFrame:
    """(name, track, k, value): the header's NAME=v1,v2 arguments asked for; RQ drops its leading ``0.``."""
    args = F.regexp_extract_all("header", F.lit(r"(\w+)=([^\s]+)"), F.lit(0))
    each = records.select("name", F.explode(args).alias("arg")).select("name", F.split_part("arg", F.lit("="), F.lit(1)).alias("track"), F.split_part("arg", F.lit("="), F.lit(2)).alias("v"))
    values = each.where(F.col("track").isin(names)).select("name", "track", F.posexplode(F.split("v", ",")).alias("k", "value"))
    return values.withColumn("value", F.when(F.col("track") == "RQ", F.regexp_replace("value", r"^0\.", "")).otherwise(F.col("value")))


def well_header(records: DataFrame) -> DataFrame:
    """(name, well, beg, fin) from names ``prefix/well/beg_end``; others are left out."""
    part = lambda g: F.regexp_extract("name", r"^[^/]*/([0-9]+)/([0-9]+)_([0-9]+)", g)
    return records.where(part(1) != "").select("name", part(1).cast("long").alias("well"), part(2).cast("long").alias("beg"), part(3).cast("long").alias("fin"))


def read_track(spark: SparkSession, path: str) -> DataFrame:
    return track_lines(spark.read.text(path))


def track_lines(lines: DataFrame) -> DataFrame:
    """(rid, beg, fin) of lines ``rid beg end``; lines of another form are left out."""
    p = F.split(F.trim("value"), r"\s+")
    return lines.where(F.col("value").rlike(r"^\s*[0-9]+\s+[0-9]+\s+[0-9]+\s*$")).select(p[0].cast("long").alias("rid"), p[1].cast("long").alias("beg"), p[2].cast("long").alias("fin"))


def out_of_bounds(track: DataFrame, reads: DataFrame) -> DataFrame:
    """Intervals that aren't inside their read: the reject table."""
    return track.join(reads.select("rid", "rlen"), "rid", "left").where("rlen is null or beg < 0 or fin > rlen or beg >= fin").select(*track.columns)


def gff_lines(lines: DataFrame) -> DataFrame:
    """(rid, beg, fin) of GFF lines whose sequence is a number or read_N; GFF counts from 1, ends included."""
    p = F.split("value", "\t")
    rid = F.regexp_extract(p[0], r"^(?:read_)?([0-9]+)$", 1)
    return lines.where(~F.col("value").startswith("#") & (F.size(p) >= 8) & (rid != "")).select(rid.cast("long").alias("rid"), (p[3].cast("long") - 1).alias("beg"), p[4].cast("long").alias("fin"))


def id_ranges(lines: DataFrame, reads: DataFrame) -> DataFrame:
    """Reads of a list of ids and ranges ``a-b``: (rid)."""
    p = F.regexp_extract("value", r"^\s*([0-9]+)(?:-([0-9]+))?\s*$", 1)
    q = F.regexp_extract("value", r"^\s*([0-9]+)(?:-([0-9]+))?\s*$", 2)
    spans = lines.where(p != "").select(p.cast("long").alias("lo"), F.when(q != "", q.cast("long")).otherwise(p.cast("long")).alias("hi"))
    return spans.where("hi >= lo").select(F.explode(F.sequence("lo", "hi")).alias("rid")).distinct().join(reads.select("rid"), "rid", "left_semi")


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    names = "qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string"
    return spark.read.csv(path, sep="\t", schema=names, quote="").where(~F.col("qname").startswith("@"))


def tgf_nodes(lines: DataFrame) -> DataFrame:
    """Lines ``id label``: (rid, label). The edges have a third field."""
    return lines.where(F.col("value").rlike(r"^[0-9]+ [^0-9 ]\S*$")).select(F.split_part("value", F.lit(" "), F.lit(1)).cast("long").alias("rid"), F.split_part("value", F.lit(" "), F.lit(2)).alias("label"))


def tgf_edges(lines: DataFrame) -> DataFrame:
    """Lines ``src dst label``: (src, dst, label)."""
    p = lambda k: F.split_part("value", F.lit(" "), F.lit(k))
    return lines.where(F.col("value").rlike(r"^[0-9]+ [0-9]+ \S+$")).select(p(1).cast("long").alias("src"), p(2).cast("long").alias("dst"), p(3).alias("label"))


def path_lines(lines: DataFrame) -> DataFrame:
    """Lines ``PATH id end1 end2 v-w v-w ...``: (path, end1, end2, pos, src, dst)."""
    p = F.split("value", " ")
    steps = lines.where(F.col("value").startswith("PATH ")).select(p[1].cast("long").alias("path"), p[2].cast("long").alias("end1"), p[3].cast("long").alias("end2"), F.posexplode(F.filter(F.slice(p, 5, F.greatest(F.size(p) - 4, F.lit(0))), lambda x: x != "")).alias("pos", "step"))
    return steps.select("path", "end1", "end2", "pos", F.split_part("step", F.lit("-"), F.lit(1)).cast("long").alias("src"), F.split_part("step", F.lit("-"), F.lit(2)).cast("long").alias("dst"))

"""Session helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from overlace.llm.kernels import tidy


#: Bytes of one Arrow batch to a Python worker, about: memory of both sides follows it.
BATCH_BYTES = 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only in a local session without the setting, as in tests, a temporary folder takes its
    place; on a cluster it would be a folder of one machine, so there it's an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.conf.get("spark.master", "").startswith("local") or spark.conf.get("spark.master").startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="overlace-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This cuts the lineage, so a lost executor costs a re-read and no recomputation,
    and lets later steps prune columns.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/overlace-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the table behind a ``stored`` result that nothing reads any more."""
    spark = df.sparkSession
    jvm, own = spark.sparkContext._jvm, shared_dir(spark)
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if folder.rsplit("/", 1)[1].startswith("overlace-") and path.getParent().getName() == own.rsplit("/", 1)[1]:
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def map_batches(df: DataFrame, run, schema: str) -> DataFrame:
    """``df.mapInArrow`` in batches of bounded bytes; a worker gives freed memory back when a task ends.

    The session's bound on a batch's bytes is lowered to ``BATCH_BYTES``; a lower one stays.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    found = conf.get(name)
    if not found.isdigit() or int(found) > BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))
    return df.mapInArrow(tidy(run), schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_small(df: DataFrame, limit: int = 16 << 20) -> bool:
    """Whether ``df`` takes at most ``limit`` bytes: the check before a broadcast.

    Every row counts 16 bytes, and each column 8 or, of texts and lists, what they hold.
    """
    most = limit // (16 + 8 * len(df.columns))
    width = F.lit(16)
    for field in df.schema:
        kind = field.dataType.typeName()
        held = F.octet_length(field.name) + 8 if kind in ("string", "binary") else F.size(field.name) * 24 if kind == "array" else F.lit(8)
        width = width + F.coalesce(held, F.lit(0))
    row = df.limit(most + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("bytes")).first()
    return row["n"] <= most and row["bytes"] <= limit


def met(df: DataFrame, other: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join that broadcasts ``other`` only if its bytes are few."""
    return df.join(F.broadcast(other) if is_small(other) else other, on, how)


def crc_mod(column: str, n: int):
    """crc32 of the id's decimal text, modulo ``n``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n

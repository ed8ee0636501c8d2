"""Token-id files: one zstandard dictionary, one frame for each document.

A folder holds

* ``dictionary``: a zstandard dictionary, trained on the serialised id arrays of a bounded
  sample of documents (``SAMPLE`` of them, ``HEAD`` bytes of each at most: what a
  dictionary helps is the begin of a frame);
* ``ids-*.bin``: files of at most about ``FILE`` bytes. A file begins with ``MAGIC`` and
  the SHA-256 of the dictionary; then come frames, one for each document in ascending
  order of doc_id, compressed apart, of ids as little-endian unsigned integers of 16 bits
  or, for larger vocabularies, 32;
* ``index/``: Parquet, one row for each document: doc_id, the file, offset and size of its
  frame, start (the ids of all documents before it), n_tokens, the width of an id and the
  dictionary's hash.

A short document is read by one ranged read of its frame. Tasks write files under names of
their own, and the index names those of the tasks that Spark took, so a task that runs
again, on a lost executor or twice at a time, leaves at most a file that no row names.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from overlace.llm.common import map_batches, met, shared_dir, stored
from overlace.llm.packing import Parts, default_tokenizer

END_ID, LEVEL = 2, 3
#: Documents that the dictionary is trained on and bytes of each at most; bytes of the dictionary, of a file and of a read at most, about.
SAMPLE, HEAD, DICTIONARY, FILE, READ = 4096, 2048, 64 << 10, 128 << 20, 4 << 20
MAGIC = b"OVLIDS1\n"
HEADER = len(MAGIC) + 32


def opened(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder's address and the folder's path there."""
    system, path = pafs.FileSystem.from_uri(folder)
    return system, path.rstrip("/")


def encoded(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, n_tokens, ids (serialised) of every document; the end id is the last."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        words = Parts(tokenizer, end_id)
        width = words.width
        for batch in batches:
            for low, ids, at in words.encode(batch.column(1)):
                raw = pa.py_buffer(ids.astype(f"<u{width}").tobytes())
                where = pa.py_buffer((at * width).astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, len(at) - 1), pa.array(np.diff(at), pa.int64()), pa.array(np.full(len(at) - 1, width), pa.int32()), pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, where, raw])],
                    names=["doc_id", "n_tokens", "width", "ids"],
                )

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, n_tokens long, width int, ids binary")


def train_dictionary(ids: DataFrame) -> bytes:
    """A dictionary from ``SAMPLE`` documents (a column ``_row`` numbers them), those of the least hashes, ``HEAD`` bytes of each.

    Tasks send about twice as many to the driver, all together.
    """
    code = F.xxhash64("_row")
    share = min(1.0, 2 * SAMPLE / max(1, ids.count()))
    few = ids.where(F.pmod(code, F.lit(1 << 40)) < int(share * (1 << 40)) + 1)
    heads = few.orderBy(code).limit(SAMPLE).select(F.substring("ids", 1, HEAD).alias("head"))
    samples = [bytes(r.head) for r in heads.collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few or too short samples: their bytes are the dictionary
        return b"".join(samples)[-DICTIONARY:]


def _codec(raw: bytes):
    return zstandard.ZstdCompressionDict(raw) if raw else None


def write_ids(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Write the ids of all ``docs`` (doc_id, text) to ``folder``, which must not exist yet.

    Null text counts as empty: the end id alone. Null doc_ids come first; rows of one
    doc_id are each written, in the order of a hash of their ids. An empty table gives a folder
    with an empty index. ``folder`` is an address that Spark and Arrow both open (a path,
    file:, hdfs:, s3:, gs:) and that the driver and all executors share.
    """
    ids = stored(encoded(docs, tokenizer or default_tokenizer(), end_id).withColumn("_row", F.monotonically_increasing_id()))
    dictionary = train_dictionary(ids)
    system, path = opened(folder)
    system.create_dir(path)
    with system.open_output_stream(f"{path}/dictionary") as out:
        out.write(dictionary)
    kind = docs.schema["doc_id"].dataType.simpleString()
    digest = hashlib.sha256(dictionary).digest()

    def run(batches):
        system, path = opened(folder)
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=_codec(dictionary)).compress
        part, number, name, out, at, start = TaskContext.get().partitionId(), -1, "", None, 0, 0
        for batch in batches:
            n_tokens = batch.column("n_tokens").to_pylist()
            files, numbers, offsets, sizes, starts = [], [], [], [], []
            for raw, n in zip(batch.column("ids"), n_tokens, strict=True):
                if out is None or at >= FILE:
                    if out is not None:
                        out.close()
                    number, at, start = number + 1, HEADER, 0
                    name = f"ids-{part:06d}-{number:04d}-{uuid.uuid4().hex}.bin"
                    out = system.open_output_stream(f"{path}/{name}")
                    out.write(MAGIC + digest)
                frame = pack(memoryview(raw.as_buffer()))
                out.write(frame)
                files.append(name)
                numbers.append((part << 20) + number)
                offsets.append(at)
                sizes.append(len(frame))
                starts.append(start)
                at, start = at + len(frame), start + n
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_tokens"), batch.column("width"), pa.array(files, pa.string()), pa.array(numbers, pa.int64()), pa.array(offsets, pa.int64()), pa.array(sizes, pa.int64()), pa.array(starts, pa.int64())],
                names=["doc_id", "n_tokens", "width", "file", "number", "offset", "size", "in_file"],
            )
        if out is not None:
            out.close()

    # Ties are dealt by more columns, so that many rows of one doc_id don't meet in one task.
    ordered = ids.repartitionByRange("doc_id", F.xxhash64("ids"), "_row").sortWithinPartitions("doc_id", F.xxhash64("ids"), "_row").drop("_row")
    rows = stored(map_batches(ordered, run, f"doc_id {kind}, n_tokens long, width int, file string, number long, offset long, size long, in_file long"))
    # Files in order are few: their totals give each one's start.
    totals = rows.groupBy("number").agg(F.sum("n_tokens").alias("held"))
    before = totals.select("number", (F.sum("held").over(W.orderBy("number")) - F.col("held")).alias("before"))
    index = met(rows, before, "number").select("doc_id", "file", "offset", "size", (F.col("before") + F.col("in_file")).alias("start"), "n_tokens", "width", F.lit(digest.hex()).alias("dictionary"))
    index.sortWithinPartitions("file", "offset").write.parquet(f"{folder}/index")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/index")


def read_frames(index: DataFrame, folder: str, fields: str, make) -> DataFrame:
    """``make(row, ids)`` for each row of ``index``; frames that lie side by side are read at a time, up to ``READ`` bytes."""
    names = [f.split(" ")[0].strip("`") for f in fields.split(", ")]

    def run(batches):
        system, path = opened(folder)
        with system.open_input_stream(f"{path}/dictionary") as f:
            dictionary = f.read()
        digest = hashlib.sha256(dictionary).digest()
        unpack = zstandard.ZstdDecompressor(dict_data=_codec(dictionary)).decompress
        name, source = None, None
        for batch in batches:
            rows, low = batch.to_pylist(), 0
            while low < len(rows):
                first, high = rows[low], low + 1
                while high < len(rows) and rows[high]["file"] == first["file"] and rows[high]["offset"] == rows[high - 1]["offset"] + rows[high - 1]["size"] and rows[high]["offset"] + rows[high]["size"] - first["offset"] <= READ:
                    high += 1
                if first["file"] != name:
                    name, source = first["file"], system.open_input_file(f"{path}/{first['file']}")
                    if source.read_at(HEADER, 0) != MAGIC + digest:
                        raise ValueError(f"{name} wasn't written with the dictionary of its folder")
                held = memoryview(source.read_at(rows[high - 1]["offset"] + rows[high - 1]["size"] - first["offset"], first["offset"]))
                made = []
                for row in rows[low:high]:
                    at = row["offset"] - first["offset"]
                    made.append(make(row, np.frombuffer(unpack(held[at : at + row["size"]]), f"<u{row['width']}")))
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*made, strict=True), kinds, strict=True)], names=names)
                low = high

    kinds = [to_arrow_type(f.dataType) for f in index.sparkSession.createDataFrame([], fields).schema]
    return map_batches(index, run, fields)


def read_ids(index: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids of the documents of ``index``, all or a selection of its rows."""
    kind = index.schema["doc_id"].dataType.simpleString()
    return read_frames(index, folder, f"doc_id {kind}, start long, n_tokens long, ids array<int>", lambda row, ids: (row["doc_id"], row["start"], len(ids), ids.tolist()))


def lookup(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """``read_ids`` of the documents whose doc_id is in ``wanted``; only their frames are read."""
    return read_ids(met(read_index(spark, folder), wanted.select("doc_id").distinct(), "doc_id", "left_semi"), folder)


def digests(index: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of what the files hold."""
    kind = index.schema["doc_id"].dataType.simpleString()
    return read_frames(index, folder, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long", lambda row, ids: (row["doc_id"], row["start"], len(ids), zlib.crc32(ids.astype("<u4").tobytes())))


def round_trip(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` to a new folder in the shared one and read all of it back: doc_id, start, n_tokens, ids_crc32.

    Odd rows: as ``write_ids`` states. Other columns of ``docs`` don't matter.
    """
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/overlace-ids-{uuid.uuid4().hex}"
    write_ids(docs, folder, tokenizer, end_id)
    return digests(read_index(spark, folder), folder)

"""Fuzzy line deduplication.

Lines become sets of character shingles; lines of equal bytes (A-Z lower-cased, white
space at the ends removed) are one node. MinHash bands make buckets, pairs within them
are verified by exact Jaccard similarity and a distributed union-find keeps one line, the
first by (doc_id, line number), of each component.

A shingle is a run of code points, as a 64-bit hash. Signatures are one-permutation
MinHash: a shingle's hash picks one of ``BANDS * ROWS`` bins, a bin's value is the least
hash in it, and an empty bin takes the value of another one, found by probing bins in an
order that is the same for all lines. Each value agrees with the probability of the Jaccard
similarity, for one hash a shingle. With 22 bands of 6 a pair at the threshold 0.8 shares a
bucket with probability 1 - (1 - 0.8**6)**22 > 0.998.

Each task groups its lines by bucket before the shuffle and sends one line of each bucket
to the part of buckets that it belongs to; lines that meet within the task are known to
share a bucket and go anywhere. So a bucket that holds a third of all lines sends one row
a task, and a part has a bounded number of entries. Lines that share a bucket travel as
texts, which are an eighth of their sets; a pair's sets are made where they are compared.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from overlace.llm import kernels as K
from overlace.llm.common import discard, map_batches, met, stored
from overlace.llm.neardup import linked_roots

BANDS, ROWS = 22, 6
VALUES = BANDS * ROWS
#: Bytes of text in a chunk; lines whose buckets a task groups together; entries (line, bucket) in a part of the buckets, about.
CHUNK, GROUPED, PART = 1 << 18, 40_000, 1_000_000
#: Bits of the map of lines whose texts are wanted, at most.
MARKS = 1 << 25
#: Probes of an empty bin, each an order of all bins; a line whose probes all fail takes its least value.
PROBES = np.array([np.random.Generator(np.random.PCG64(31 + k)).permutation(VALUES) for k in range(64)])
EMPTY = np.uint32(0xFFFFFFFF)
ODD = np.random.Generator(np.random.PCG64(30)).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BAND_SALT = K.mix(np.arange(1, BANDS + 1, dtype=np.uint64))
BLANK = b" \t\n\x0b\x0c\r"


def text_lines(column):
    """(row of each line, number of the line in its row, lines) by chunks of rows: bytes, A-Z lower-cased, without
    white space at the ends. A row of n line feeds has n + 1 lines."""
    for low, _, part, at in K.chunks(*K.text_bytes(column), CHUNK):
        raw = K.LOWER[part].tobytes()
        split = [raw[i:j].split(b"\n") for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        yield low + np.repeat(np.arange(len(split)), counts), K.ranges(np.zeros(len(split), np.int64), counts), [x.strip(BLANK) for row in split for x in row]


def digests(lines: list[bytes]) -> list[bytes]:
    """128 bits of each line."""
    make = hashlib.blake2b
    return [make(x, digest_size=16).digest() for x in lines]


def _keys(nodes: list[bytes]) -> np.ndarray:
    """The first 64 bits of each digest."""
    return np.frombuffer(b"".join(nodes), ">i8").astype(np.int64)[::2]


def shingles(lines: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of ``size`` code points of non-empty lines in order, and the line offsets; a shorter line is one shingle."""
    points = np.frombuffer(b"\n".join(lines).decode().encode("utf-32-le"), np.uint32).astype(np.uint64)
    ends = np.append(np.flatnonzero(points == 10), len(points))
    starts = np.concatenate([[0], ends[:-1] + 1])
    length = ends - starts
    total = np.zeros(len(points), np.uint64)
    for k in range(min(size, len(points))):
        total[: len(points) - k] += points[k:] * ODD[k]
    # Of a line's positions the last size - 1 begin no shingle.
    begins = np.ones(len(points), bool)
    begins[ends[:-1]] = False
    for k in range(1, size):
        begins[np.maximum(ends - k, starts)[length >= 1]] = False
    short = np.flatnonzero(length < size)
    begins[starts[short]] = True
    for i in short.tolist():  # rare: lines below one shingle
        total[starts[i]] = np.append(points[starts[i] : ends[i]] * ODD[: length[i]], ODD[32 + length[i]]).sum()
    x = total[begins]
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33)), np.concatenate([[0], np.cumsum(np.maximum(length - size + 1, 1))])


def line_sets(lines: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each line, ascending, and the line offsets."""
    if not lines:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    made, at = shingles(lines, size)
    for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        made[i:j].sort()
    fresh = np.ones(len(made), bool)
    fresh[1:] = made[1:] != made[:-1]
    fresh[at[:-1]] = True
    return made[fresh], np.concatenate([[0], np.cumsum(np.add.reduceat(fresh, at[:-1], dtype=np.int64))])


def signatures(made: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One-permutation MinHash values of non-empty sets (repeated items count once): array [sets, VALUES]."""
    n = len(at) - 1
    own = np.full(n * VALUES, EMPTY, np.uint32)
    place = np.repeat(np.arange(n) * VALUES, np.diff(at)) + (((made >> np.uint64(32)) * np.uint64(VALUES)) >> np.uint64(32)).astype(np.int64)
    np.minimum.at(own, place, np.minimum((made & np.uint64(0xFFFFFFFF)).astype(np.uint32), EMPTY - np.uint32(1)))
    out, left = own.copy(), np.flatnonzero(own == EMPTY)
    for probe in PROBES:
        if not len(left):
            break
        column = left % VALUES
        out[left] = own[left - column + probe[column]]
        left = left[out[left] == EMPTY]
    out = out.reshape(n, VALUES)
    if len(left):
        out.ravel()[left] = own.reshape(n, VALUES).min(1)[left // VALUES]
    return out


def band_keys(made: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Band keys of non-empty sets: array [sets, BANDS]."""
    values = signatures(made, at).reshape(-1, BANDS, ROWS)
    keys = np.broadcast_to(BAND_SALT, values.shape[:2]).copy()
    for j in range(ROWS):
        keys += values[:, :, j] * ODD[j]
    return K.mix(keys)


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values))


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, line, node, key, n) of every line: 128 bits of it, 64 of them as ``key``, its bytes; node is null for a line of white space only. Lines count from 0."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for rows, number, lines in text_lines(batch.column(1)):
                nodes = digests(lines)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(number, pa.int32()), pa.array([n if x else None for n, x in zip(nodes, lines, strict=True)], pa.binary()), pa.array(_keys(nodes)), pa.array([len(x) for x in lines], pa.int64())],
                    names=["doc_id", "line", "node", "key", "n"],
                )

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, line int, node binary, key long, n long")


def _entries(keys: np.ndarray, buckets: np.ndarray, parts: int) -> pa.RecordBatch:
    """A row for each part: of each bucket of these lines one entry (low, key); and entries known
    to share their bucket (shared_low, shared_part, shared_key), dealt to any part.

    A bucket is its part, by its high half, and its low half.
    """
    key, bucket = np.repeat(keys, BANDS), buckets.ravel()
    # Sorted by the high half and the place in one number; should other buckets of that half
    # stand between equal ones, the part's task, which sees both, puts them together.
    order = (np.sort((bucket >> np.uint64(32) << np.uint64(32)) | np.arange(len(bucket), dtype=np.uint64)) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    key, bucket = key[order], bucket[order]
    lead = np.ones(len(bucket), bool)
    lead[1:] = bucket[1:] != bucket[:-1]
    part = (((bucket >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int32)
    low = bucket.astype(np.uint32).view(np.int32)
    number = np.arange(parts)
    one = np.bincount(part[lead], minlength=parts)  # buckets ascend, so parts do
    several = ~lead
    several[:-1] |= ~lead[1:]
    rest = np.flatnonzero(several)
    to = (key[rest] % np.uint64(parts)).astype(np.int64)
    rest = rest[np.argsort(to, kind="stable")]
    many = np.bincount(to, minlength=parts)
    return pa.RecordBatch.from_arrays(
        [pa.array(number, pa.int32()), _lists(low[lead], one), _lists(key[lead].view(np.int64), one), _lists(part[rest], many), _lists(low[rest], many), _lists(key[rest].view(np.int64), many)],
        names=["part", "low", "key", "shared_part", "shared_low", "shared_key"],
    )


def _joined(column) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy() if column.num_chunks else np.zeros(0, np.int64)


def _meet(table: pa.Table) -> pa.Table:
    """(bucket, key) of all entries of a part that share a bucket with another line."""
    if not table.num_rows:
        return pa.table({"bucket": pa.array([], pa.int64()), "key": pa.array([], pa.int64())})
    part = np.int64(table.column("part")[0].as_py())
    low, key = _joined(table.column("low")), _joined(table.column("key"))
    # Most entries are alone with their low half: only the others are sorted by key, too.
    order = np.sort(low.view(np.uint32).astype(np.uint64) << np.uint64(32) | np.arange(len(low), dtype=np.uint64))
    half = order >> np.uint64(32)
    several = np.zeros(len(low), bool)
    several[1:] |= half[1:] == half[:-1]
    several[:-1] |= half[1:] == half[:-1]
    order = (order[several] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    order = order[np.lexsort((key[order], low[order]))]
    low, key = low[order], key[order]
    fresh = np.ones(len(low), bool)
    fresh[1:] = (low[1:] != low[:-1]) | (key[1:] != key[:-1])
    low, key = low[fresh], key[fresh]
    same = low[1:] == low[:-1]
    together = np.zeros(len(low), bool)
    together[1:] |= same
    together[:-1] |= same
    name = lambda part, low: (np.asarray(part, np.int64) << 32) | low.view(np.uint32).astype(np.int64)
    bucket = name(part, low[together])
    shared = name(_joined(table.column("shared_part")), _joined(table.column("shared_low")).astype(np.int32))
    return pa.table({"bucket": np.concatenate([bucket, shared]), "key": np.concatenate([key[together], _joined(table.column("shared_key"))])})


def shared_buckets(docs: DataFrame, size: int, parts: int) -> DataFrame:
    """(bucket, key) of the lines that share a bucket with a different line."""

    def run(batches):
        held: dict[bytes, bytes] = {}
        for batch in batches:
            for _, _, lines in text_lines(batch.column(0)):
                held |= {x: None for x in lines if x}
                if len(held) >= GROUPED:
                    yield flushed([*held])
                    held = {}
        if held:
            yield flushed([*held])

    def flushed(lines):
        buckets, low = np.empty((len(lines), BANDS), np.uint64), 0
        sizes = np.cumsum([len(x) for x in lines])
        while low < len(lines):  # a chunk of text at a time
            high = max(low + 1, int(np.searchsorted(sizes, (sizes[low - 1] if low else 0) + CHUNK, side="right")))
            buckets[low:high] = band_keys(*shingles(lines[low:high], size))
            low = high
        return _entries(_keys(digests(lines)).view(np.uint64), buckets, parts)

    entries = map_batches(docs.select("text"), run, "part int, low array<int>, key array<long>, shared_part array<int>, shared_low array<int>, shared_key array<long>")
    return entries.groupBy("part").applyInArrow(_meet, "bucket long, key long")


def _bit(rows: np.ndarray, number: np.ndarray, bits: int) -> np.ndarray:
    """The bit, of so many, of each line, by a hash of its doc_id and its number."""
    return (K.mix(rows.view(np.uint64) + number.astype(np.uint64) * ODD[40]) & np.uint64(bits - 1)).astype(np.int64)


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, items): the bytes of the wanted nodes, from the first line that is each, and of some other nodes.

    ``wanted``: (doc_id, line, node). Documents stay where they are: every task gets a bit map of the wanted lines, of
    at most ``MARKS`` bits. Lines that hit a bit by chance come along; a fuller map lets more of them through, and loses none.
    """
    spots = stored(wanted.select(F.xxhash64("doc_id").alias("row"), "line").distinct())
    bits = min(MARKS, 1 << max(6, (spots.count() * 8).bit_length()))

    def mark(batches):
        for batch in batches:
            at = _bit(batch.column(0).to_numpy(), batch.column(1).to_numpy(), bits)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))], names=["word", "bits"])

    marked = map_batches(spots, mark, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[marked.column("word").to_numpy()] = marked.column("bits").to_numpy().view(np.uint64)

    def run(batches):
        for batch in batches:
            hashes = batch.column(0).to_numpy()
            for rows, number, lines in text_lines(batch.column(1)):
                at = _bit(hashes[rows], number, bits)
                hit = np.flatnonzero(words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1))
                found = [x for i in hit.tolist() if (x := lines[i])]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(digests(found), pa.binary()), pa.array(found, pa.binary())], names=["node", "items"])

    return map_batches(docs.select(F.xxhash64("doc_id").alias("row"), "text"), run, "node binary, items binary").dropDuplicates(["node"])


def _checked(size: int, percent: int):
    """Which of the pairs (a, b) are linked, by the shingle sets of their texts."""

    def check(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        left = sets.select(F.col("node").alias("a"), F.col("items").alias("_a"))
        right = sets.select(F.col("node").alias("b"), F.col("items").alias("_b"))

        def run(batches):
            for batch in batches:
                other = batch.column(3).dictionary_encode()
                made_b, at_b = line_sets(other.dictionary.to_pylist(), size)
                made, at = line_sets(batch.column(2).to_pylist(), size)
                which, linked = other.indices.to_numpy(), np.zeros(len(batch), bool)
                for i in range(len(batch)):
                    a, b = made[at[i] : at[i + 1]], made_b[at_b[which[i]] : at_b[which[i] + 1]]
                    if 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                        place = np.searchsorted(b, a)
                        both = np.count_nonzero(b[np.minimum(place, len(b) - 1)] == a)
                        linked[i] = 100 * both >= percent * (len(a) + len(b) - both)
                yield batch.select(["a", "b"]).filter(pa.array(linked))

        return map_batches(pairs.join(left, "a").join(right, "b").select("a", "b", "_a", "_b"), run, "a binary, b binary")

    return check


def fuzzy_lines(docs: DataFrame, *, percent: int = 80, shingle: int = 5) -> DataFrame:
    """(doc_id, line, component, kept) of every line of every document.

    Lines are split at line feeds and count from 0. Two lines are linked when 100 *
    |intersection| >= ``percent`` * |union| of their sets of shingles of ``shingle`` characters, and of each component
    the first line by (doc_id, line) is kept. Lines of white space only are in no
    component and kept; so are all lines of a null doc_id. Null text counts as empty, one
    empty line. Repeated rows of one doc_id and text are marked alike. An empty table
    gives an empty result.
    """
    lines = stored(lines_of(docs))
    named = lines.where("node is not null and doc_id is not null")
    parts = max(1, -(-named.count() * BANDS // PART))
    shared = shared_buckets(docs.where("doc_id is not null"), shingle, parts).distinct()
    # Equal lines are one node: partial aggregates take care of very common ones.
    nodes = stored(named.groupBy("node", "key").agg(F.min(F.struct("doc_id", "line")).alias("at"), F.max("n").alias("n"), F.count("*").alias("times")))
    members = stored(shared.join(nodes.select("key", "node", "n", "at"), "key").drop("key"))
    texts = stored(_texts(docs, members.select("node", "at.doc_id", "at.line").distinct()))

    def expand(items: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        return line_sets(items.to_list(), shingle)

    roots = linked_roots(members.drop("at"), texts, percent, check=_checked(shingle, percent), expand=expand)
    for df in (members, texts):
        discard(df)

    rooted = stored(roots.join(nodes.select("node", "at"), "node"))
    first = stored(rooted.groupBy("root").agg(F.min("at").alias("first")))
    placed = met(rooted.select("node", "root"), first, "root").select("node", F.col("root").alias("component"), "first")
    # Lines that occur once and are linked with none are kept; the others need to know which is first.
    several = stored(nodes.select("node", "at", "times").join(placed, "node", "left").where("times > 1 or component is not null").select("node", F.coalesce("component", "node").alias("component"), F.coalesce("first", "at").alias("first")))
    marked = met(lines.select("doc_id", "line", F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node")), several, "node", "left")
    kept = F.coalesce((F.col("doc_id") == F.col("first.doc_id")) & (F.col("line") == F.col("first.line")), F.lit(True))
    return marked.select("doc_id", "line", F.coalesce("component", "node").alias("component"), kept.alias("kept"))


def line_report(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, dropped (the numbers of its dropped lines, in order)."""
    gone = F.when(~F.col("kept"), F.col("line"))
    return fuzzy_lines(docs, **options).groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count(gone).alias("n_dropped"), F.sort_array(F.collect_set(gone)).alias("dropped"))


def without_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with its dropped lines cut out of the text; other columns as they are."""
    report = line_report(docs, **options).where("n_dropped > 0 and doc_id is not null").select("doc_id", "dropped")
    kept = F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains("dropped", i))
    out = docs.join(report, "doc_id", "left").withColumn("text", F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")))
    return out.select(*docs.columns)

"""Exact deduplication against an immutable snapshot, screened by binary-fuse filters.

The snapshot's distinct digests are dealt to buckets, and each bucket gets a static
binary-fuse filter (three slots a key, 8-bit fingerprints). The incoming batch is first
grouped by digest on its own; its distinct digests then meet the filter of their bucket.
What the filter rules out is new for certain. The rest joins the snapshot's exact
digests. Every digest with more than one row is checked byte for byte; should different
texts share a digest, their rows are grouped by text instead.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from overlace.llm.common import met, stored
from overlace.llm.kernels import mix

#: Distinct digests to a bucket, about.
BUCKET = 50_000


def _slots(keys: np.ndarray, seed: int, length: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The three slots of each key, in three successive segments, and its fingerprint."""
    h = mix(keys + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64)))
    first = ((h >> np.uint64(32)) * np.uint64(segments * length)) >> np.uint64(32)
    part = np.uint64(length - 1)
    second = (first + np.uint64(length)) ^ ((h >> np.uint64(18)) & part)
    third = (first + np.uint64(2 * length)) ^ (h & part)
    return np.stack([first, second, third]).astype(np.int64), ((h ^ (h >> np.uint64(32))) & np.uint64(255)).astype(np.uint8)


def fuse_build(keys: np.ndarray) -> dict:
    """A binary-fuse filter of distinct 64-bit keys.

    Keys are peeled in rounds: those that are alone in a slot go, and give their slot
    its value once the later ones are set.
    """
    n = len(keys)
    if not n:
        return {"seed": 0, "length": 4, "segments": 0, "table": b""}
    length = 1 << min(18, max(2, int(np.log(n) / np.log(3.33) + 2.25))) if n > 1 else 4
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    segments = max(1, -(-round(n * factor) // length) - 2)
    for seed in range(1, 200):
        slots, prints = _slots(keys, seed, length, segments)
        size = (segments + 2) * length
        degree = np.bincount(slots.ravel(), minlength=size)
        owner = np.zeros(size, np.int64)  # the xor of the keys in a slot: the key, if it's one
        for s in slots:
            np.bitwise_xor.at(owner, s, np.arange(n))
        rounds, left = [], n
        while left:
            alone = np.flatnonzero(degree == 1)
            if not len(alone):
                break
            key, at = np.unique(owner[alone], return_index=True)
            rounds.append((key, alone[at]))
            for s in slots:
                np.subtract.at(degree, s[key], 1)
                np.bitwise_xor.at(owner, s[key], key)
            left -= len(key)
        if left:
            continue
        table = np.zeros(size, np.uint8)
        for key, slot in reversed(rounds):
            table[slot] = 0
            table[slot] = prints[key] ^ table[slots[0][key]] ^ table[slots[1][key]] ^ table[slots[2][key]]
        return {"seed": seed, "length": length, "segments": segments, "table": table.tobytes()}
    raise ValueError("no seed of 199 gives a filter: the keys aren't distinct")


def fuse_contains(filter_: dict, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be in the filter; keys that are in it always may."""
    if not filter_["segments"]:
        return np.zeros(len(keys), bool)
    table = np.frombuffer(filter_["table"], np.uint8)
    slots, prints = _slots(keys, filter_["seed"], filter_["length"], filter_["segments"])
    return table[slots[0]] ^ table[slots[1]] ^ table[slots[2]] == prints


def _keys(digests: pd.Series) -> np.ndarray:
    """64 bits of each hex digest, all of them used."""
    width = 16
    out = np.zeros(len(digests), np.uint64)
    for low in range(0, max(map(len, digests), default=0), width):
        out = mix(out ^ np.fromiter((int(d[low : low + width] or "0", 16) for d in digests), np.uint64, len(digests)))
    return out


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    made = fuse_build(np.unique(_keys(rows["digest"])))
    return pd.DataFrame([{"bucket": rows["bucket"].iloc[0], **made}])


def _screen(rows: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    maybe = fuse_contains(filters.iloc[0].to_dict(), _keys(rows["digest"])) if len(filters) and len(rows) else np.zeros(len(rows), bool)
    return rows.assign(maybe=maybe).drop(columns="bucket")


def build_filters(groups: DataFrame, buckets: int) -> DataFrame:
    """bucket, seed, length, segments, table: one filter a bucket of the snapshot's digests."""
    return bucketed(groups.select("digest"), buckets).groupBy("bucket").applyInPandas(_build, "bucket long, seed int, length int, segments long, table binary")


def bucketed(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)))


def exact_duplicates(incoming: DataFrame, snapshot: DataFrame | None = None, *, digest_of=lambda sha: sha, bucket: int = BUCKET) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of batch and snapshot.

    Both have doc_id, text and any other columns. Of equal texts the row with the largest
    doc_id stays. ``digest_of`` maps the sha256 to the digest in use.

    Null text counts as empty. Null doc_ids never win against others; in a group of null
    doc_ids only, keep_id is null and all rows are kept. Repeated rows of one doc_id and
    text are one document: they count in group_size and are marked alike. Empty tables
    give an empty result.
    """
    text = F.coalesce("text", F.lit(""))
    old = (incoming.limit(0) if snapshot is None else snapshot).select("doc_id", "text", F.lit(False).alias("new"))
    both = incoming.select("doc_id", "text", F.lit(True).alias("new")).unionByName(old)
    sha = F.sha2(text.cast("binary"), 256)
    rows = stored(both.select("doc_id", "new", sha.alias("text_sha256")).withColumn("digest", digest_of(F.col("text_sha256"))))
    per_digest = (F.count("*").alias("n"), F.max("doc_id").alias("top"))
    new_groups = rows.where("new").groupBy("digest").agg(*per_digest)
    new_groups, old_groups = stored(new_groups), stored(rows.where("not new").groupBy("digest").agg(*per_digest))
    # Both sides of a bucket are bounded; digests of buckets without a filter are new.
    buckets = max(1, -(-max(old_groups.count(), new_groups.count()) // bucket))
    filters = stored(build_filters(old_groups, buckets))
    kind = rows.schema["doc_id"].dataType.simpleString()
    known, dealt = filters.select("bucket"), bucketed(new_groups, buckets)
    screened = met(dealt, known, "bucket", "left_semi").groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(_screen, f"digest string, n long, top {kind}, maybe boolean")
    fresh = met(dealt, known, "bucket", "left_anti").select("digest", "n", "top", F.lit(False).alias("maybe"))
    screened = stored(screened.select("digest", "n", "top", "maybe").unionByName(fresh))

    found = old_groups.select("digest", F.col("n").alias("n_old"), F.col("top").alias("top_old"))
    positive = screened.where("maybe").join(found, "digest", "left")
    merged = positive.select("digest", (F.col("n") + F.coalesce("n_old", F.lit(0))).alias("n"), F.greatest("top", "top_old").alias("top"))
    untouched = old_groups.join(screened.where("maybe").select("digest"), "digest", "left_anti")
    groups = stored(merged.unionByName(screened.where("not maybe").select("digest", "n", "top")).unionByName(untouched.select("digest", "n", "top")))

    # The byte check: equal texts are those whose least and greatest are the same. It needs
    # no pairs, and partial aggregates shrink a large group before the shuffle.
    repeated = groups.where("n > 1").select("digest")
    texts = both.select("doc_id", text.alias("text"), sha.alias("text_sha256")).withColumn("digest", digest_of(F.col("text_sha256")))
    checked = met(texts.select("digest", "text"), repeated, "digest", "left_semi")
    unequal = stored(checked.groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high")).where("low != high").select("digest"))
    if unequal.limit(1).count():
        apart = texts.join(unequal, "digest", "left_semi")
        by_text = stored(apart.groupBy("digest", "text").agg(*per_digest))  # a table, so that a hot text's rows can be split
        out = rows.join(unequal, "digest", "left_anti").join(groups, "digest").select("doc_id", "text_sha256", "n", "top")
        out = out.unionByName(apart.join(by_text, ["digest", "text"]).select("doc_id", "text_sha256", "n", "top"))
    else:
        out = rows.join(groups, "digest").select("doc_id", "text_sha256", "n", "top")
    return out.select("doc_id", F.col("top").alias("keep_id"), F.col("n").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("top")).alias("kept"), "text_sha256")


def build_snapshot(docs: DataFrame, folder: str, *, bucket: int = BUCKET) -> None:
    """Write the snapshot of ``docs`` (doc_id, text) to ``folder``, once: distinct digests by bucket (with their number of rows,
    their largest doc_id and one text), and a filter for each bucket. The number of buckets is fixed then.

    Null text counts as empty, null doc_ids count in a group and never win against others.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.sha2(text.cast("binary"), 256).alias("digest"))
    groups = stored(rows.groupBy("digest").agg(F.count("*").alias("n"), F.max("doc_id").alias("top")))
    buckets = max(1, -(-groups.count() // bucket))
    bucketed(groups, buckets).write.partitionBy("bucket").parquet(f"{folder}/digests")
    # Equal texts are one row; a digest of unlike texts has several.
    bucketed(rows.select("digest", "text").distinct(), buckets).write.partitionBy("bucket").parquet(f"{folder}/texts")
    build_filters(groups, buckets).withColumn("buckets", F.lit(buckets)).write.parquet(f"{folder}/filters")


def against_snapshot(batch: DataFrame, folder: str, *, bucket: int = BUCKET) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, in_snapshot of every row of ``batch`` (doc_id, text), against a stored snapshot.

    The batch is grouped by text on its own. Its digests meet the snapshot's filters; what
    they rule out is new. The others join the digests of their buckets, and those found
    there join their texts byte for byte; nothing else of the snapshot is read. Of equal
    texts the row with the largest doc_id stays, wherever it lies. Odd rows: as in
    ``exact_duplicates``.
    """
    spark = batch.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = stored(batch.select("doc_id", text.alias("text"), F.sha2(text.cast("binary"), 256).alias("digest")))
    own = stored(rows.groupBy("digest", "text").agg(F.count("*").alias("n"), F.max("doc_id").alias("top")))
    filters = spark.read.parquet(f"{folder}/filters")
    first = filters.select("buckets").first()
    buckets = first["buckets"] if first else 1
    asked = bucketed(own.select("digest").distinct(), buckets)
    # A large batch cuts a bucket's digests to parts, and each part gets a copy of the filter.
    parts = max(1, -(-asked.count() // (buckets * bucket)))
    dealt = asked.withColumn("part", F.pmod(F.xxhash64(F.lit(7), "digest"), F.lit(parts)))
    copies = filters.drop("buckets").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))

    def screen(rows_: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        return _screen(rows_, held).drop(columns="part")

    maybe = dealt.groupBy("bucket", "part").cogroup(copies.groupBy("bucket", "part")).applyInPandas(screen, "digest string, maybe boolean").where("maybe").select("digest")
    positive = stored(bucketed(maybe, buckets))
    wanted = [r["bucket"] for r in positive.select("bucket").distinct().collect()] if buckets <= 1 << 16 else None

    def old(name: str) -> DataFrame:
        df = spark.read.parquet(f"{folder}/{name}")
        df = df if wanted is None else df.where(F.col("bucket").isin(wanted))  # other buckets' files aren't opened
        return df.join(positive.select("digest"), "digest", "left_semi")

    found = stored(old("digests").select("digest", F.col("n").alias("n_old"), F.col("top").alias("top_old"))) if first else None
    if found is None or not found.limit(1).count():
        merged = own.select("digest", "text", "n", "top", F.lit(False).alias("in_snapshot"))
    else:
        same = own.join(old("texts").select("digest", "text"), ["digest", "text"]).select("digest", "text", F.lit(True).alias("in_snapshot"))
        met_ = own.join(same, ["digest", "text"], "left").join(found, "digest", "left")
        inside = F.coalesce("in_snapshot", F.lit(False))
        merged = met_.select("digest", "text", (F.col("n") + F.when(inside, F.col("n_old")).otherwise(0)).alias("n"), F.when(inside, F.greatest("top", "top_old")).otherwise(F.col("top")).alias("top"), inside.alias("in_snapshot"))
    out = rows.join(merged, ["digest", "text"])
    return out.select("doc_id", F.col("top").alias("keep_id"), F.col("n").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("top")).alias("kept"), F.col("digest").alias("text_sha256"), "in_snapshot")


def table_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``exact_duplicates`` within one table: half of its rows, by a hash of the id, are taken
    for the stored snapshot and the other half for the incoming batch."""
    old = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0, F.lit(False))
    return exact_duplicates(docs.where(~old), docs.where(old), **options)


SQL = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id, count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""

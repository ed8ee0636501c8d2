"""The prefix trie of conversations, from whole sequences.

1. Every turn of a conversation gets the key of the prefix that it ends: 192 bits, sums
   over the turns so far of hashes of (place, SHA-256 of the turn). Texts don't travel.
2. Conversations of the same last key are equal: they collapse to one sequence with a
   weight, its smallest member and the list of members, which goes through SHA-256 in
   sorted chunks that many tasks make.
3. Sequences whose key is that of a proper prefix of another one drop out by an anti-join:
   those left are the leaves.
4. Nodes are the prefixes of all sequences, weighted: members, smallest member, leaves.
5. A sum over subtrees takes no walk: each node belongs to one leaf below it, and a node's
   sum is that, over the leaves below, of what they own from its depth on.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from overlace.llm.common import map_batches, stored

#: Every how many conversations share a head, and the most turns of one.
EVERY, HEADS = 100, 6
#: Bytes of a chunk of a list of members.
CHUNK = 64 << 10


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 1, digest, size): the turns of each conversation; null role or text is empty."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = conversations.where("conv_id is not null").select("conv_id", "turn", digest.alias("digest"), F.char_length(text).cast("long").alias("size"))
    place = F.row_number().over(W.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest"))
    return turns.withColumn("place", place.cast("long")).drop("turn")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, digest, size): every conversation c rebuilt. Its first h turns are those of
    c - c % 100, with h = crc32(c) % 6; its own follow, from h + 1 on. A row of place 0 stands
    for each conversation, so that those without turns are there too.

    ``conversations``: conv_id, turn, role, text and any other columns. Turns of one number
    come in the order of a hash of role and text; repeated rows are turns of their own. Rows
    of a null conv_id belong to no conversation and are left out.
    """
    turns = stored(turns_in_order(conversations))
    every = turns.groupBy("conv_id").agg(F.max("place").alias("n")).select("conv_id", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("h"), (F.col("conv_id") - F.col("conv_id") % EVERY).alias("base"))
    heads = turns.where(F.col("place") < HEADS).select(F.col("conv_id").alias("base"), "place", "digest", "size")
    head = every.where("h > 0").join(heads, "base").where("place <= h").select("conv_id", "place", "digest", "size")
    # Own turns follow the head, which may be shorter than h.
    shift = every.join(heads.groupBy("base").agg(F.max("place").alias("held")), "base", "left").select("conv_id", "h", F.least("h", F.coalesce("held", F.lit(0))).alias("taken"))
    own = turns.join(shift, "conv_id").where("place > h").select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "digest", "size")
    start = every.select("conv_id", F.lit(0).cast("long").alias("place"), F.lit("").alias("digest"), F.lit(0).cast("long").alias("size"))
    return head.unionByName(own).unionByName(start)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, size, key, parent, last): each prefix of each conversation by its key."""
    w = W.partitionBy("conv_id").orderBy("place")
    so_far = w.rowsBetween(W.unboundedPreceding, 0)
    part = lambda i: F.when(F.col("place") == 0, 0).otherwise(F.xxhash64(F.lit(i), "place", "digest")).cast("decimal(20,0)")
    keyed = turns.select("conv_id", F.col("place").alias("depth"), "size", "place", F.struct(*(F.sum(part(i)).over(so_far).cast("decimal(38,0)").alias(f"k{i}") for i in range(3))).alias("key"))
    return keyed.select("conv_id", "depth", "size", "key", F.lag("key").over(w).alias("parent"), F.lead("depth").over(w).isNull().alias("last"))


def end_lists(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of the members' ids of each key, sorted, joined by commas.

    Ids are sorted by ranges, so many tasks share a key; each makes chunks of its ids, and
    the chunks of a key, 1 / ``CHUNK`` of it, go through the hash in order. Nothing is held
    but one chunk.
    """
    name = F.concat_ws("_", *(F.col("key")[f"k{i}"].cast("string") for i in range(3)))
    ids = ends.select(name.alias("name"), "conv_id")

    def chunked(batches):
        name, first, held, size = None, None, [], 0
        out = []

        def close():
            if held:
                out.append((name, first, ",".join(held)))

        for batch in batches:
            for key, i in zip(batch.column("name").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if key != name or size >= CHUNK:
                    close()
                    name, first, held, size = key, i, [], 0
                held.append(str(i))
                size += len(held[-1]) + 1
            if out:
                yield table(out, ("name", "first", "ids"), (pa.string(), pa.int64(), pa.string()))
                out = []
        close()
        if out:
            yield table(out, ("name", "first", "ids"), (pa.string(), pa.int64(), pa.string()))

    def hashed(batches):
        name, sha, done = None, None, []
        for batch in batches:
            for key, ids_ in zip(batch.column("name").to_pylist(), batch.column("ids"), strict=True):
                if key != name:
                    if name is not None:
                        done.append((name, sha.hexdigest()))
                    name, sha = key, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids_.as_buffer())
            if done:
                yield table(done, ("name", "ends_sha256"), (pa.string(), pa.string()))
                done = []
        if name is not None:
            yield table([(name, sha.hexdigest())], ("name", "ends_sha256"), (pa.string(), pa.string()))

    def table(rows, names, types):
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=list(names))

    chunks = map_batches(ids.repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id"), chunked, "name string, first long, ids string")
    lists = map_batches(chunks.repartition("name").sortWithinPartitions("name", "first"), hashed, "name string, ends_sha256 string")
    parts = F.split("name", "_")
    return lists.select(F.struct(*(parts[i].cast("decimal(38,0)").alias(f"k{i}") for i in range(3))).alias("key"), "ends_sha256")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations of ``turns`` (conv_id, place, digest, size; place 0 once each).

    Returns conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, by the rules of the trie: members start with the prefix, subtrees include
    their top, and the root stands for no turns. No conversations give no rows, not even a
    root.
    """
    every = stored(prefixes(turns))
    # Whole sequences: equal conversations collapse to one, known by its smallest member.
    ended = every.where("last").select("key", "conv_id")
    sequences = stored(ended.groupBy("key").agg(F.count("*").alias("weight"), F.min("conv_id").alias("conv_id")))
    rows = stored(every.join(sequences.select("conv_id", "weight"), "conv_id").select("conv_id", "weight", "depth", "size", "key", "parent", "last"))
    # Proper prefixes of others drop out; the leaves are left.
    proper = rows.where("not last").select("key").distinct()
    leaves = sequences.join(proper, "key", "left_anti").select("conv_id", F.lit(True).alias("leaf"))
    marked = stored(rows.join(leaves, "conv_id", "left").withColumn("leaf", F.coalesce("leaf", F.lit(False))))
    nodes = stored(
        marked.groupBy("key").agg(
            F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.first("size").alias("size"),
            F.sum("weight").alias("n_convs"), F.sum(F.col("leaf").cast("long")).alias("n_leaves"), F.min(F.when(F.col("leaf"), F.col("conv_id"))).alias("owner"),
        )
    )
    # What each node saves goes to its owner, and from there to all nodes of the owner's path above.
    own = nodes.select(F.col("owner").alias("conv_id"), "depth", ((F.col("n_convs") - 1) * F.col("size")).alias("saves"))
    below = W.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(W.unboundedPreceding, 0)
    paths = marked.where("leaf").select("conv_id", "depth", "key").join(own, ["conv_id", "depth"], "left")
    saved = paths.select("key", F.sum(F.coalesce("saves", F.lit(0))).over(below).alias("saves")).groupBy("key").agg(F.sum("saves").alias("saved_tokens"))
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    full = stored(nodes.drop("size", "owner").join(saved, "key").join(children, "key", "left").join(end_lists(ended), "key", "left"))
    parents = full.where("n_children > 0").select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return full.join(parents, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


#: The same over the table, with whole texts in place of keys.
SQL = """
WITH RECURSIVE t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
bits AS (SELECT DISTINCT conv_id, conv_id::VARCHAR AS name FROM t),
crc AS (
  SELECT conv_id, name, 1 AS i, 4294967295::BIGINT AS c FROM bits
  UNION ALL
  SELECT conv_id, name, i + 1, xor(c9 >> 8, tab) FROM (
    SELECT conv_id, name, i, c AS c9, list_reduce(list_prepend(xor(c & 255, ascii(name[i])::BIGINT), range(8)), lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS tab FROM crc WHERE i <= length(name)) s),
every AS (SELECT conv_id, xor(c, 4294967295) % 6 AS h, conv_id - conv_id % 100 AS base FROM crc WHERE i = length(name) + 1),
whole AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY place) AS turns FROM t GROUP BY conv_id),
seqs AS (
  SELECT e.conv_id, list_concat(coalesce(b.turns[:e.h], []), own.turns[e.h + 1:]) AS turns
  FROM every e JOIN whole own ON own.conv_id = e.conv_id LEFT JOIN whole b ON b.conv_id = e.base),
nodes AS (
  SELECT p, len(p) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs
  FROM (SELECT conv_id, turns[:d] AS p FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM seqs) u) v GROUP BY p),
saves AS (SELECT *, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(p[depth].text) END AS s FROM nodes),
ups AS (SELECT p[:d] AS top, depth = d + 1 AS child, s, p FROM (SELECT *, unnest(range(depth + 1)) AS d FROM saves) u),
inner_ AS (SELECT DISTINCT p[:depth - 1] AS p FROM nodes WHERE depth > 0),
sums AS (SELECT top, sum(s) AS saved, count(*) FILTER (child) AS n_children, count(*) FILTER (p NOT IN (SELECT p FROM inner_)) AS n_leaves FROM ups GROUP BY top),
ends AS (SELECT turns, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS sha FROM seqs GROUP BY turns)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, n.n_convs, CAST(s.n_children AS BIGINT) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, coalesce(e.sha, sha256('')) AS ends_sha256
FROM nodes n JOIN sums s ON s.top = n.p LEFT JOIN nodes q ON n.depth > 0 AND q.p = n.p[:n.depth - 1] LEFT JOIN ends e ON e.turns = n.p
"""

"""MinHash near-deduplication with min-max hashing.

1. Each document becomes the set of its distinct word shingles (64-bit hashes) and a
   signature: under each permutation both the minimum and the maximum are kept, so half
   as many hash evaluations give the same number of values. Documents with equal sets
   become one node, known by a 128-bit hash of the set.
2. Bands of signature values make buckets. In a bucket every node is checked on full
   sets against one hub, the node that shares most buckets with others: copies of a text
   gather around it, so links grow with the bucket, not with its square.
3. What is left are nodes of a hub's buckets that aren't connected with it. They are
   checked, on full sets, against all others of these buckets: in blocks of a bounded
   number of shingles, two blocks to a task, and a task returns only links that connect
   what isn't connected yet. No pair that shares a bucket is dropped, and none is a row.
4. Connected components by distributed union-find.

With 96 permutations (192 values, 32 bands of 6) a pair at the threshold 0.85 misses all
buckets with probability (1 - 0.85**6)**32 < 3e-7.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from overlace.llm import kernels as K
from overlace.llm.common import discard, map_batches, stored

SHINGLE, PERMUTATIONS, BANDS, ROWS = 5, 96, 32, 6
#: Pairs of sets that a block looks at at a time.
PAIRS = 1 << 20
_rng = np.random.Generator(np.random.PCG64(20))
TIMES = _rng.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32) | np.uint32(1)
PLUS = _rng.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)
_FOLD = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(data: np.ndarray, at: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending within each row, and the row offsets.

    A row of fewer words has its whole sequence as one shingle; one without words none.
    """
    data = K.LOWER[data]
    starts, ends, rows = K.words(data, at, K.SPACE)
    n, n_rows = len(starts), len(at) - 1
    words = K.strong_hashes(data, starts, ends)
    number = np.bincount(rows, minlength=n_rows)
    made, of = [], []
    for length in range(1, size + 1):
        at_first = np.flatnonzero(number[rows] == length) if length < size else np.arange(n)
        if length < size:
            at_first = at_first[np.diff(rows[at_first], prepend=-1) != 0]
        else:
            at_first = at_first[: max(0, n - size + 1)]
            at_first = at_first[rows[at_first] == rows[at_first + size - 1]]
        h = np.full(len(at_first), length, np.uint64)
        for j in range(length):
            h = (h ^ words[at_first + j]) * _FOLD
            h ^= h >> np.uint64(29)
        made.append(K.mix(h))
        of.append(rows[at_first])
    made, of = np.concatenate(made), np.concatenate(of)
    order = np.lexsort((made, of)) if n_rows > 1 else np.argsort(made)
    made, of = made[order], of[order]
    fresh = np.ones(len(made), bool)
    fresh[1:] = (made[1:] != made[:-1]) | (of[1:] != of[:-1])
    made, of = made[fresh], of[fresh]
    return made, np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n_rows))])


def band_keys(made: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Band keys of non-empty sets, which start at ``first``: array [sets, BANDS]."""
    x = (made >> np.uint64(32)).astype(np.uint32)
    low, high = np.empty((2, PERMUTATIONS, len(first)), np.uint32)
    for k in range(PERMUTATIONS):
        h = x * TIMES[k] + PLUS[k]
        low[k], high[k] = np.minimum.reduceat(h, first), np.maximum.reduceat(h, first)
    keys = np.empty((len(first), BANDS), np.uint64)
    step = PERMUTATIONS // (ROWS // 2)
    for b in range(BANDS):
        key = np.full(len(first), b + 1, np.uint64)
        for j in range(ROWS // 2):
            for values in (low[(b + j * step) % PERMUTATIONS], high[(b + 11 + j * step) % PERMUTATIONS]):
                key = K.mix((key ^ values) * _FOLD)
        keys[:, b] = key
    return keys


def _set_ids(made: np.ndarray, at: np.ndarray) -> list[bytes]:
    """128-bit hash of each set."""
    sums = [np.concatenate([[np.uint64(0)], np.cumsum(K.mix(made ^ np.uint64(salt)))]) for salt in (0x1234567, 0x89ABCDEF12345)]
    size = np.diff(at).astype(np.uint64)
    two = np.stack([K.mix((s[at[1:]] - s[at[:-1]]) ^ (size << np.uint64(40))) for s in sums], 1)
    raw = two.astype(">u8").tobytes()
    return [raw[i : i + 16] for i in range(0, len(raw), 16)]


def _lists(values: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.view(np.int64)))


def _map_sets(docs: DataFrame, bands: bool) -> DataFrame:
    """doc_id, node, n_shingles and, for non-empty sets, the band keys or else the set."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for low, high, part, where in K.chunks(*K.text_bytes(batch.column(1))):
                made, at = shingle_sets(part, where)
                ids, size = _set_ids(made, at), np.diff(at)
                if bands:
                    full = size > 0
                    keys = band_keys(made, at[:-1][full]) if full.any() else np.zeros((0, BANDS), np.uint64)
                    listed = _lists(keys.ravel(), np.concatenate([[0], np.cumsum(full * BANDS)]))
                else:
                    listed = _lists(made, at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(ids, pa.binary()), pa.array(size, pa.int64()), listed], names=["doc_id", "node", "n_shingles", "items"]
                )

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, node binary, n_shingles long, items array<long>")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), root the smallest node reachable.

    Alternates large-star and small-star until nothing changes: each round joins and
    groups on nodes, and a hub's neighbours meet by partial minima, never as one list.
    """
    edges = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    before = None
    while True:
        # Large star: every larger neighbour of u, and u itself, to u's smallest neighbour.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a and m < b").select(F.col("m").alias("a"), "b").distinct()
        # Small star: u and its smaller neighbours to the smallest of them.
        small = large.groupBy("b").agg(F.min("a").alias("m"))
        linked = large.join(small, "b")
        old, edges = edges, stored(linked.where("a != m").select(F.col("m").alias("a"), F.col("a").alias("b")).unionByName(small.select(F.col("m").alias("a"), "b")).distinct())
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        discard(old)
        if now == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
        before = now


def _checked(percent: int):
    """Which of the pairs (a, b) are linked, by their full sets."""

    def check(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        left = sets.select(F.col("node").alias("a"), F.col("items").alias("_a"))
        right = sets.select(F.col("node").alias("b"), F.col("items").alias("_b"))
        both = F.size(F.array_intersect("_a", "_b"))
        sized = pairs.join(left, "a").join(right, "b").select("a", "b", both.alias("i"), (F.size("_a") + F.size("_b") - both).alias("u"))
        return sized.where(F.col("i") * 100 >= F.col("u") * percent).select("a", "b")

    return check


def _expand(items: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """The sets of a column of sets, one after the other, and their offsets."""
    return np.concatenate(items.to_list()), np.concatenate([[0], np.cumsum([len(x) for x in items])])


def linked_pairs(made: np.ndarray, at: np.ndarray, percent: int, stray: np.ndarray, root: np.ndarray) -> list[tuple[int, int]]:
    """Linked pairs of sets, one of them a stray, of different roots.

    Codes are ordered from rare to frequent. Two linked sets share one of the larger one's
    first |A| - t |A| + 1 codes and the smaller one's first |B| - 2t / (1 + t) |B| + 1, t
    the threshold; pairs that do are counted in full.
    """
    size, n = np.diff(at), len(at) - 1
    _, code, times = np.unique(made, return_inverse=True, return_counts=True)
    rank = np.empty(len(times), np.int64)
    rank[np.argsort(times, kind="stable")] = np.arange(len(times))
    owner = np.repeat(np.arange(n), size)
    code = rank[code]
    code = code[np.lexsort((code, owner))]
    place = np.arange(len(code)) - at[owner]
    large = np.flatnonzero(place <= size[owner] + (-percent * size // 100)[owner])
    small = np.flatnonzero(place <= size[owner] + (-2 * percent * size // (100 + percent))[owner])
    small = small[np.argsort(code[small], kind="stable")]
    begin, end = (np.searchsorted(code[small], code[large], side) for side in ("left", "right"))
    found, steps, low = [np.zeros(0, np.int64)], np.cumsum(end - begin), 0
    while low < len(large):
        high = max(low + 1, int(np.searchsorted(steps, (steps[low - 1] if low else 0) + PAIRS, side="right")))
        count = end[low:high] - begin[low:high]
        i, j = np.repeat(owner[large[low:high]], count), owner[small[K.ranges(begin[low:high], count)]]
        fit = (size[j] < size[i]) | ((size[j] == size[i]) & (j < i))
        fit &= (100 * size[j] >= percent * size[i]) & (stray[i] | stray[j]) & (root[i] != root[j])
        found.append(np.unique(i[fit] * n + j[fit]))
        low = high
    i, j = np.divmod(np.unique(np.concatenate(found)), max(n, 1))
    mark, linked = np.zeros(len(times), bool), []
    heads = np.flatnonzero(np.diff(i, prepend=-1))
    for low, high in zip(heads, np.append(heads[1:], len(i)), strict=False):  # without pairs no heads
        own, others = code[at[i[low]] : at[i[low] + 1]], j[low:high]
        mark[own] = True
        ends = np.cumsum(size[others])
        both = np.add.reduceat(mark[code[K.ranges(at[others], size[others])]], ends - size[others], dtype=np.int64)
        mark[own] = False
        near = others[100 * both >= percent * (len(own) + size[others] - both)]
        linked += [(int(i[low]), int(x)) for x in near]
    return linked


def _block_links(percent: int, expand):
    """Links between two blocks of nodes that join different roots, as few as connect what they connect."""

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("stray", ascending=False, kind="stable").drop_duplicates("node", ignore_index=True)
        made, at = expand(rows["items"])
        names = {r: i for i, r in enumerate(dict.fromkeys(rows["root"]))}
        parent = list(range(len(names)))
        root = np.array([names[r] for r in rows["root"]])

        def find(i):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        found = []
        for i, j in linked_pairs(made, at, percent, rows["stray"].to_numpy(bool), root):
            a, b = find(root[i]), find(root[j])
            if a != b:
                parent[a] = b
                found.append((rows["node"][i], rows["node"][j]))
        return pd.DataFrame(found, columns=["a", "b"])

    return run


def linked_roots(members: DataFrame, sets: DataFrame, percent: int, *, block: int = 100_000, nodes: int = 1_000, check=None, expand=_expand) -> DataFrame:
    """(node, root) of nodes that are linked with others.

    ``members``: (bucket, node, n), buckets of two nodes or more, n the size of the set, about;
    ``sets``: (node, items), the full sets of all of them, or what ``check`` (pairs, sets) and
    ``expand`` (items) make them from. ``block``: items in a block of
    sets, about; ``nodes``: sets in it, about. Memory of a task follows two blocks, and the
    largest set.
    """
    # A node's buckets are few, so counting them needs no split; the hubs are a table, so that
    # Spark can split the rows of a large bucket when they meet its hub.
    ranked = members.join(members.groupBy("node").agg(F.count("*").alias("popularity")), "node")
    hubs = stored(ranked.groupBy("bucket").agg(F.max(F.struct("popularity", "n", "node")).alias("h")).select("bucket", F.col("h.node").alias("hub")))
    around = stored(members.join(hubs, "bucket").where("node != hub").select("hub", "node", "n").distinct())
    links = stored((check or _checked(percent))(around.select(F.col("node").alias("a"), F.col("hub").alias("b")), sets))
    roots = components(links)

    hub_roots = roots.select(F.col("node").alias("hub"), F.col("root").alias("hub_root"))
    rooted = around.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = rooted.join(hub_roots, "hub", "left").withColumn("stray", F.col("root") != F.coalesce("hub_root", "hub"))
    rooted = stored(rooted.select("hub", "node", "n", "root", "stray"))
    # A hub's strays and its other nodes are cut to blocks apart; strays meet strays and others.
    blocks = lambda kind: F.ceil(F.greatest(F.sum(F.when(kind, F.col("n"))) / block, F.sum(F.when(kind, 1)) / nodes)).cast("int")
    sizes = rooted.groupBy("hub").agg(blocks(F.col("stray")).alias("s"), F.coalesce(blocks(~F.col("stray")), F.lit(0)).alias("m"), F.count("*").alias("c"), F.sum("n").alias("total"))
    sizes = stored(sizes.where("s > 0 and c > 1").withColumn("little", (F.col("c") * 8 <= nodes) & (F.col("total") * 4 <= block)))
    dealt = rooted.join(sizes, "hub")
    # Hubs with little around them share a task: pairs across them are true links or none, too.
    row = sizes.where("little").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("c"), F.coalesce(F.sum("total"), F.lit(0)).alias("total")).first()
    bundles = max(1, -(-row["c"] // nodes), -(-row["total"] // block))
    none = F.lit(None).cast("binary")
    together = dealt.where("little").select(none.alias("hub"), F.pmod(F.xxhash64("hub"), F.lit(bundles)).alias("x"), F.lit(-1).cast("long").alias("y"), "node", "root", "stray")
    dealt = dealt.where("not little").withColumn("own", F.when(F.col("stray"), F.pmod(F.xxhash64("node"), "s")).otherwise(F.col("s") + F.pmod(F.xxhash64("node", "hub"), F.greatest("m", F.lit(1)))))
    partners = F.when(F.col("stray"), F.sequence(F.lit(0).cast("long"), (F.col("s") + F.col("m") - 1).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), (F.col("s") - 1).cast("long")))
    apart = dealt.withColumn("other", F.explode(partners)).select("hub", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "node", "root", "stray")
    met_ = together.unionByName(apart).groupBy("hub", "x", "y", "node").agg(F.first("root").alias("root"), F.bool_or("stray").alias("stray"))
    more = stored(met_.join(sets, "node").groupBy("hub", "x", "y").applyInPandas(_block_links(percent, expand), "a binary, b binary"))
    if more.limit(1).count():
        roots = components(links.unionByName(more))
    return roots


def near_duplicates(docs: DataFrame, *, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document.

    ``docs``: doc_id, text and any other columns. Two documents are linked when
    100 * |intersection| >= ``percent`` * |union| of their shingle sets.

    Null, empty and word-less texts have the empty set, are linked with nothing and kept.
    A null doc_id is linked with nothing too, its component_id is null and it is kept.
    Repeated rows of one doc_id and text have one component and are all returned; rows of
    one doc_id with different texts count as different documents. An empty table gives an
    empty result.
    """
    signed = stored(_map_sets(docs, bands=True))
    named = signed.where("n_shingles > 0 and doc_id is not null")
    nodes = stored(named.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("items").alias("keys")))

    spread = nodes.select("node", "n", F.explode("keys").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    members = stored(spread.join(shared.select("bucket"), "bucket"))
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select("doc_id", F.col("node").alias("want"))
    texts = docs.select("doc_id", "text").join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = stored(_map_sets(texts, bands=False).join(wanted.select(F.col("want").alias("node")), "node", "left_semi").select("node", "items").dropDuplicates(["node"]))

    roots = linked_roots(members, sets, percent)

    found = roots.join(nodes.select("node", "doc_id"), "node")
    smallest = found.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    placed = found.join(smallest, "root").select("node", "component_id")
    alone = nodes.select("node", F.col("doc_id").alias("own"))
    of = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "own", "doc_id")).otherwise(F.col("doc_id"))
    out = signed.select("doc_id", "node", "n_shingles").join(alone, "node", "left").join(placed, "node", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), of).alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))

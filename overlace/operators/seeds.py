"""k-mers, seed joins and diagonal bands on reads (rid, seq).

A k-mer of up to 31 bases is a number, two bits a base. Tasks make the numbers from runs of
bases with numpy and count them before the shuffle; everything after is joins and
aggregates on the number. The two strands share one pass: a k-mer and its reverse
complement have one canonical number, the smaller one.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from overlace.functions.scalar import floor_div, reverse_complement
from overlace.operators.storage import stored

#: Bases that a task handles at a time; a longer read is cut to pieces that overlap.
RUN = 1 << 20
BASE = np.full(256, 4, np.uint8)
for _i, _letters in enumerate(("aA", "cC", "gG", "tT")):
    BASE[[ord(x) for x in _letters]] = _i
#: How a k-mer reads on either strand: forward it's canonical, backward it's canonical, or it is its own reverse complement.
FORWARD, BACKWARD, PALINDROME = 0, 1, 2
#: Distinct k-mers up to which a table of them is broadcast.
FEW = 1 << 20
#: Buckets of k-mers, as bits; stretches that a task lets meet at a time, if their buckets allow it; the columns of a stretch; a read without an id.
BUCKET_BITS, MET, NOBODY = 12, 1 << 18, -(1 << 63)
STRETCH = {"rid": np.int64, "pos": np.int32, "size": np.int32, "bases": np.int64, "n": np.int8}


def _spots(column, k: int):
    """(row, pos, code, turned) in runs of bases: every k-mer of a column of reads without other letters than acgt,
    its number and that of its reverse complement."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + RUN, side="right")) - 1)
        high = min(high, len(column))
        for begin in range(int(offsets[low]), max(int(offsets[high]) - k + 1, int(offsets[low]) + 1), RUN if high == low + 1 else 1 << 62):
            end = min(int(offsets[high]), begin + RUN + k - 1) if high == low + 1 else int(offsets[high])
            base = BASE[data[begin:end]]
            m = len(base) - k + 1
            if m < 1:
                continue
            code, turned = np.zeros(m, np.int64), np.zeros(m, np.int64)
            bits = base.astype(np.int64) & 3
            for i in range(k):
                code = code << 2 | bits[i : i + m]
                turned |= (3 - bits[i : i + m]) << 2 * i
            other = np.concatenate([[0], np.cumsum(base == 4)])
            row = np.searchsorted(offsets[low : high + 1], begin + np.arange(m), side="right") - 1
            whole = (other[k:] == other[:m]) & (begin + np.arange(m) + k <= offsets[low + row + 1])
            row = row[whole] + low
            yield row, begin + np.flatnonzero(whole) - offsets[row], code[whole], turned[whole]
        low = high


def kmer_codes(seqs: DataFrame, k: int) -> DataFrame:
    """(rid, pos, code) of every k-mer of acgt."""

    def run(batches):
        for batch in batches:
            for row, pos, code, _ in _spots(batch.column(1), k):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(pos), pa.array(code)], names=["rid", "pos", "code"])

    return seqs.select("rid", "seq").mapInArrow(run, "rid long, pos long, code long")


def code_counts(seqs: DataFrame, k: int) -> DataFrame:
    """(code, n): how often each k-mer of acgt occurs; counted in the tasks first."""

    def run(batches):
        for batch in batches:
            for _, _, code, _ in _spots(batch.column(1), k):
                found, n = np.unique(code, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["code", "n"])

    return seqs.select("rid", "seq").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def kmer_text(code, k: int):
    """The letters of a k-mer's number."""
    return F.translate(F.lpad(F.conv(code.cast("string"), 10, 4), k, "0"), "0123", "acgt")


def kmers(seqs: DataFrame, k: int) -> DataFrame:
    """(rid, pos, kmer) of every k-mer of acgt, as text."""
    return kmer_codes(seqs, k).select("rid", "pos", kmer_text(F.col("code"), k).alias("kmer"))


def kmer_counts(seqs: DataFrame, k: int, *, most: int = 255) -> DataFrame:
    return code_counts(seqs, k).select(kmer_text(F.col("code"), k).alias("kmer"), F.least("n", F.lit(most)).alias("n"))


def kmer_histogram(counts: DataFrame, *, most: int = 255) -> DataFrame:
    """(n, kmers): how many k-mers occur n times, below the cap."""
    return counts.where(F.col("n") < most).groupBy("n").agg(F.count("*").alias("kmers"))


def kmer_cutoffs(counts: DataFrame, *, share: float = 0.01, error: float = 0.15, cov: float = 10, k: int = 8, genome: int = 1_000_000) -> DataFrame:
    """One row: ``over``, the count from which k-mers are the top ``share``; ``noise``, the expected count of a true k-mer without errors."""
    per = counts.groupBy("n").agg(F.count("*").alias("kmers"))
    top, whole = F.sum("kmers").over(W.orderBy(F.desc("n")).rowsBetween(W.unboundedPreceding, 0)), F.sum("kmers").over(W.partitionBy())
    over = per.withColumn("top", top).withColumn("total", whole).where(F.col("top") >= F.ceil(F.col("total") * share)).agg(F.max("n").alias("over"))
    expected = genome / 4.0**k * cov * (1 - error) ** k
    return over.select("over", F.lit(int(expected)).cast("long").alias("noise"))


def _with_counts(spots: DataFrame, counts: DataFrame, k: int, how: str = "inner") -> DataFrame:
    """A join on the code; the counts are broadcast where there can't be more than ``FEW``."""
    return spots.join(F.broadcast(counts) if 4**k <= FEW else counts, "code", how)


def frequent_removed(seqs: DataFrame, k: int, most: int) -> DataFrame:
    """(rid, pos, code) of the k-mers that occur at most ``most`` times: a semi join on aggregated counts, before any self-join."""
    return _with_counts(kmer_codes(seqs, k), code_counts(seqs, k).where(F.col("n") <= most).select("code"), k, "left_semi")


def budget_cut(counts: DataFrame, budget: int) -> DataFrame:
    """One row: ``most``, the largest count up to which k-mers (``counts``: n each) make at most ``budget`` matched pairs, a k-mer of n
    places n (n - 1) / 2; the ``pairs`` up to it; and those up to the next count that occurs (null without one). 0 where none fits."""
    per = counts.groupBy(F.col("n").cast("long").alias("n")).agg(F.count("*").alias("kmers"))  # one row for each count
    pairs = F.col("kmers").cast("decimal(38,0)") * F.col("n") * (F.col("n") - 1) / 2
    upto = per.withColumn("upto", F.sum(pairs.cast("decimal(38,0)")).over(W.orderBy("n").rowsBetween(W.unboundedPreceding, 0)).cast("long"))
    fits = F.col("upto") <= budget
    return upto.agg(F.coalesce(F.max(F.when(fits, F.col("n"))), F.lit(0)).alias("most"), F.coalesce(F.max(F.when(fits, F.col("upto"))), F.lit(0)).alias("pairs"), F.min(F.when(~fits, F.col("upto"))).alias("next_pairs"))


def seed_pairs_within(seqs: DataFrame, k: int, budget: int, *, identity: bool = False) -> DataFrame:
    """``seed_pairs`` of the k-mers whose places, on both strands, make at most ``budget`` pairs; the cut is known before places meet."""
    most = budget_cut(canonical_counts(seqs, k), budget).first()["most"]
    return seed_pairs(seqs, k, most=int(most), identity=identity)


def canonical_counts(seqs: DataFrame, k: int) -> DataFrame:
    """(code, n): places of each k-mer or its reverse complement; one that is both stands on both strands at each."""

    def count(batches):
        for batch in batches:
            for _, _, code, turned in _spots(batch.column(1), k):
                found, n = np.unique(np.minimum(code, turned), return_counts=True)
                own = np.isin(found, code[code == turned], assume_unique=False)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n * (1 + own))], names=["code", "n"])

    return seqs.select("rid", "seq").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def _buckets(code: np.ndarray, turned: np.ndarray, k: int) -> np.ndarray:
    """The bucket of each k-mer: that of the least hash of the short k-mers in it, on either strand, so that k-mers one
    after the other are mostly in one bucket and a k-mer and its reverse complement always are."""
    m = max(min(k, 10), k - 6)
    mask, least = (1 << 2 * m) - 1, np.full(len(code), (1 << 64) - 1, np.uint64)
    for i in range(k - m + 1):
        short = np.minimum(code >> 2 * (k - m - i) & mask, turned >> 2 * i & mask)
        least = np.minimum(least, short.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (least * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def _reverse_complements(bases: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of numbers of ``size`` bases each."""
    x = ~bases.astype(np.uint64)
    for shift, mask in ((2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F)):
        x = (x >> np.uint64(shift)) & np.uint64(mask) | (x & np.uint64(mask)) << np.uint64(shift)
    return (x.byteswap() >> (64 - 2 * size).astype(np.uint64)).astype(np.int64)


def stretches(seqs: DataFrame, k: int, most: int) -> DataFrame:
    """(bucket, rid, pos, size, bases, n): reads as stretches of n k-mers of one bucket, at most 31 bases in a number; a row
    holds those of one bucket and run as bytes. ``size`` is the read's length.

    Of a k-mer that a run has more than ``most`` + 1 times, so many stay: enough to see that it is too frequent.
    """
    longest = min(32 - k, k + 1)

    def cut(batches):
        for batch in batches:
            text = batch.column(1).cast(pa.large_string()).fill_null("")
            sizes = np.diff(np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1])
            rids = batch.column(0).cast(pa.int64()).fill_null(NOBODY).to_numpy()
            for row, pos, code, turned in _spots(batch.column(1), k):
                canon = np.minimum(code, turned)
                order = np.argsort(canon)
                first = np.flatnonzero(np.diff(canon[order], prepend=-1))
                rank = np.arange(len(order)) - np.repeat(first, np.diff(first, append=len(order)))
                kept = np.ones(len(order), bool)
                kept[order[rank > most]] = False
                row, pos, code, turned = row[kept], pos[kept], code[kept], turned[kept]
                if not len(row):
                    continue
                bucket = _buckets(code, turned, k)
                new = np.ones(len(row), bool)
                new[1:] = (np.diff(row) != 0) | (np.diff(pos) != 1) | (np.diff(bucket) != 0)
                first = np.flatnonzero(new)
                new |= (np.arange(len(row)) - np.repeat(first, np.diff(first, append=len(row)))) % longest == 0
                first = np.flatnonzero(new)
                n = np.diff(first, append=len(row))
                bases = code[first] << 2 * (n - 1) | code[first + n - 1] & (1 << 2 * (n - 1)) - 1
                order = np.argsort(bucket[first], kind="stable")
                first = first[order]
                ends = np.flatnonzero(np.diff(bucket[first], append=-1)) + 1
                offsets = np.concatenate([[0], ends])
                columns = (rids[row[first]], pos[first].astype(np.int32), sizes[row[first]].astype(np.int32), bases[order], n[order].astype(np.int8))
                packed = [pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer((offsets * c.itemsize).astype(np.int32)), pa.py_buffer(c)]) for c in columns]
                yield pa.RecordBatch.from_arrays([pa.array(bucket[first[ends - 1]]), *packed], names=["bucket", *STRETCH])

    return seqs.select("rid", "seq").mapInArrow(cut, "bucket int, rid binary, pos binary, size binary, bases binary, n binary")


def _bytes_of(column, kind) -> np.ndarray:
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2].slice(int(at[0]), int(at[-1] - at[0])), kind) if at[-1] > at[0] else np.zeros(0, kind)


def _places(held: list, k: int, most: int, identity: bool):
    """(rid, pos, back, strand, places) of the k-mers among the stretches of whole buckets that make seeds, k-mer by k-mer:
    ``back`` is the place on the other strand, ``places`` counts those of each k-mer."""
    rid, at, size, bases, n = (np.concatenate([_bytes_of(b.column(name), kind) for b in held]) for name, kind in STRETCH.items())
    n, mask = n.astype(np.int64), (1 << 2 * k) - 1
    of = np.repeat(np.arange(len(n)), n)
    i = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    code, turned = bases[of] >> 2 * (n[of] - 1 - i) & mask, _reverse_complements(bases, k + n - 1)[of] >> 2 * i & mask
    canon = np.minimum(code, turned)
    order = np.argsort(canon)
    first = np.flatnonzero(np.diff(canon[order], prepend=-1))
    places = np.diff(first, append=len(order))
    own = code[order[first]] == turned[order[first]]
    ok = (places * (1 + own) <= most) & ((places > 1) | identity)
    first, places = first[ok], places[ok]
    # Those that stay, k-mer by k-mer.
    here = order[np.repeat(first - np.cumsum(places) + places, places) + np.arange(int(places.sum()))]
    strand = np.where(code[here] == turned[here], PALINDROME, np.where(code[here] < turned[here], FORWARD, BACKWARD))
    rid, pos = rid[of[here]], (at[of] + i)[here]
    return rid, pos, size[of[here]] - k - pos, strand, places


def _met(rid, pos, back, strand, places, identity: bool, turn: tuple[int, int] = (0, 1)):
    """Batches of runs of seeds (``seed_runs``) of ``_places``; each place meets all places of its k-mer. Of ``turn`` (i, n)
    only A reads of the i-th of n classes are looked at."""
    group = np.repeat(np.arange(len(places)), places)
    here, begin, meets = np.arange(len(group)), (np.cumsum(places) - places)[group], places[group]
    if turn[1] > 1:
        here = np.flatnonzero(_mixed(rid) % np.uint64(turn[1]) == turn[0])
    upto = np.cumsum(meets[here])
    low = 0
    while low < len(here):
        high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + RUN, side="right")))
        mine = here[low:high]
        some = meets[mine]
        a = np.repeat(mine, some)
        b = np.repeat(begin[mine] - np.cumsum(some) + some, some) + np.arange(len(a))
        close = ((rid[b] < rid[a]) | identity & (rid[b] == rid[a])) & (rid[b] != NOBODY)
        a, b = a[close], b[close]
        both = strand[a] == PALINDROME
        comp = np.concatenate([((strand[a] != strand[b]) & ~both).astype(np.int32), np.ones(int(both.sum()), np.int32)])
        a, b = np.concatenate([a, a[both]]), np.concatenate([b, b[both]])
        x, y, p, q = rid[a], rid[b], pos[a], np.where(comp == 0, pos[b], back[b])
        fits = (y < x) | (q < p) | (comp == 1) & (q == p)
        x, y, p, q, comp = x[fits], y[fits], p[fits], q[fits], comp[fits]
        line = np.lexsort((p, q - p, comp, y, x))
        x, y, p, q, comp = x[line], y[line], p[line], q[line], comp[line]
        new = np.ones(len(x), bool)
        new[1:] = (np.diff(x) != 0) | (np.diff(y) != 0) | (np.diff(comp) != 0) | (np.diff(q - p) != 0) | (np.diff(p) != 1)
        new = np.flatnonzero(new)
        yield pa.RecordBatch.from_arrays([pa.array(v[new]) for v in (x, y, p, q, comp)] + [pa.array(np.diff(new, append=len(x)).astype(np.int32))], names=["aread", "bread", "apos", "bpos", "comp", "n"])
        low = high


def _mixed(*columns: np.ndarray) -> np.ndarray:
    """A hash of rows of numbers."""
    out = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        out = (out ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _bucket_groups(batches, held_of):
    """``held_of`` of the rows of whole buckets, some ``MET`` k-mers at a time, from batches in the order of buckets."""
    held, waiting, last = [], 0, None
    for batch in batches:
        bucket = batch.column(0).to_numpy()
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bucket)], strict=True):
            if x == y:
                continue
            if waiting >= MET and bucket[x] != last:
                yield from held_of(held)
                held, waiting = [], 0
            held.append(batch.slice(x, y - x))
            last, waiting = bucket[x], waiting + len(_bytes_of(held[-1].column("n"), np.int8))
    if held:
        yield from held_of(held)


def seed_runs(seqs: DataFrame, k: int, *, most: int = 10, identity: bool = False) -> DataFrame:
    """(aread, bread, apos, bpos, comp, n): ``seed_pairs`` as runs of n seeds, each a base behind the last in both reads.

    Reads meet as stretches dealt to buckets, in one shuffle of some four bytes a base. Runs end at their stretches'
    ends, so a seed lies in one run, but runs may touch. A task handles buckets one after the other.
    """

    def meet(batches):
        yield from _bucket_groups(batches, lambda held: _met(*_places(held, k, most, identity), identity))

    dealt = stretches(seqs, k, most).repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(meet, RUNS)


#: The columns of runs of seeds, and of the places of k-mers that make seeds.
RUNS = "aread long, bread long, apos long, bpos long, comp int, n int"
PLACES = {"rid": np.int64, "pos": np.int32, "back": np.int32, "kind": np.int8}
#: Bases up to which the seeds of all pairs are dealt at a time, bases for each part that they are dealt to, and bytes of a run when dealt.
AT_ONCE, PART, WIDE = 1 << 26, 1 << 20, 16


def seed_places(seqs: DataFrame, k: int, *, most: int = 10) -> DataFrame:
    """The places of k-mers that make seeds, those of whole buckets in a row of compressed bytes by column (``PLACES``), with the number of pairs that they make."""

    def pack(held):
        rid, pos, back, strand, places = _places(held, k, most, False)
        kind = strand.astype(np.int8)
        kind[np.cumsum(places) - places] |= 4  # a k-mer begins
        columns = [np.ascontiguousarray(c.astype(t).view(np.uint8).reshape(len(c), -1).T) for c, t in zip((rid, pos, back, kind), PLACES.values(), strict=True)]
        packed = [pa.array([pa.compress(c.tobytes(), codec="zstd", asbytes=True)], pa.binary()) for c in columns]
        yield pa.RecordBatch.from_arrays([pa.array([int((places * (places - 1) // 2).sum())]), pa.array([len(rid)]), *packed], names=["pairs", "size", *PLACES])

    dealt = stretches(seqs, k, most).repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(lambda batches: _bucket_groups(batches, pack), "pairs long, size long, rid binary, pos binary, back binary, kind binary")


def _runs_of(places: DataFrame, turn: tuple[int, int]) -> DataFrame:
    """``seed_runs`` of stored ``seed_places`` whose A reads are in the i-th of n classes (``turn``)."""

    def meet(batches):
        for batch in batches:
            for row in batch.to_pylist():
                n = row["size"]
                rid, pos, back, kind = (np.frombuffer(pa.decompress(row[c], n * np.dtype(t).itemsize, codec="zstd", asbytes=True), np.uint8).reshape(-1, n).T.copy().view(t).ravel() for c, t in PLACES.items())
                yield from _met(rid, pos.astype(np.int64), back.astype(np.int64), kind & 3, np.diff(np.flatnonzero(kind & 4), append=n), False, turn)

    return places.mapInArrow(meet, RUNS)


def pairs_mapped(seqs: DataFrame, k: int, handle, schema: str, *, most: int = 10) -> DataFrame:
    """What ``handle`` makes (batches of ``schema``) of the runs of seeds of whole pairs of reads, as arrays (aread, bread, apos, bpos, comp, n).

    Runs are dealt by pair. Chance seeds grow faster than the text, so beyond ``AT_ONCE`` bases the places of k-mers are
    stored and pairs take turns, by the A read: a turn deals no more bytes than the places have, and its results are stored.
    """

    def run(batches):
        held = [b for b in batches if len(b)]
        if held:
            yield from handle(*(np.concatenate([b.column(c).to_numpy() for b in held]) for c in range(6)))

    dealt = lambda runs, parts: runs.repartition(parts, "aread", "bread").mapInArrow(run, schema)
    bases = seqs.agg(F.sum(F.length("seq"))).first()[0] or 0
    if bases <= AT_ONCE:
        return dealt(seed_runs(seqs, k, most=most), max(1, bases // PART))
    places = stored(seed_places(seqs, k, most=most))
    pairs = places.agg(F.sum("pairs")).first()[0] or 0
    turns = max(1, -(-pairs * WIDE // (4 * bases)))
    made = [stored(dealt(_runs_of(places, (i, turns)), max(1, pairs // turns // PART))) for i in range(turns)]
    return reduce(DataFrame.unionByName, made)


def each_seed(runs: DataFrame) -> DataFrame:
    """Every seed (aread, bread, apos, bpos, comp) of runs."""
    each = runs.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return each.select("aread", "bread", (F.col("apos") + F.col("i")).alias("apos"), (F.col("bpos") + F.col("i")).alias("bpos"), "comp")


def seed_pairs(seqs: DataFrame, k: int, *, most: int = 10, identity: bool = False) -> DataFrame:
    """(aread, bread, apos, bpos, comp): equal k-mers of two reads on either strand, bread < aread.

    With ``identity`` also hits of a read with itself, bpos < apos, and, on the complement, bpos <= apos.
    k-mers of more than ``most`` positions (both strands of B) are left out before positions meet.
    """
    return each_seed(seed_runs(seqs, k, most=most, identity=identity))


def bands(pairs: DataFrame, k: int, *, width: int = 64, panel: int = 50_000, overlap: int = 10_000, least: int = 35) -> DataFrame:
    """(aread, bread, comp, panel, band, bases, a1, a2, b1, b2): pairs of adjacent diagonal bands whose seeds cover ``least`` bases of A.

    Panels of A overlap: a seed within ``overlap`` bases after a border is in the panel before it, too.
    """
    own = floor_div(F.col("apos"), panel)
    panels = F.when((F.col("apos") % panel < overlap) & (own > 0), F.array(own - 1, own)).otherwise(F.array(own))
    p = pairs.withColumn("panel", F.explode(panels)).withColumn("band", floor_div(F.col("apos") - F.col("bpos"), width))
    w = W.partitionBy("aread", "bread", "comp", "panel", "band").orderBy("apos", "bpos")
    fresh = F.least(F.lit(k), F.coalesce(F.col("apos") - F.lag("apos").over(w), F.lit(k)))
    per = p.withColumn("fresh", fresh).groupBy("aread", "bread", "comp", "panel", "band").agg(
        F.sum("fresh").alias("own"), F.min("apos").alias("a1"), (F.max("apos") + k).alias("a2"), F.min("bpos").alias("b1"), (F.max("bpos") + k).alias("b2")
    )
    nxt = W.partitionBy("aread", "bread", "comp", "panel").orderBy("band")
    beside = F.when(F.lead("band").over(nxt) == F.col("band") + 1, F.lead("own").over(nxt)).otherwise(0)
    return per.withColumn("bases", F.col("own") + beside).where(F.col("bases") >= least).drop("own")


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where rows of sorted columns differ from the one before."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def bands_of_runs(aread, bread, apos, bpos, comp, n, k: int, *, width: int = 64, panel: int = 50_000, overlap: int = 10_000, least: int = 35):
    """``bands`` from the runs of seeds of whole pairs: its columns as a dict of arrays, and the runs (apos, bpos, n) of all bands in order,
    with where those of each band found, and those of the next one beside it, begin and end.

    A run lies on one diagonal, so its seeds aren't looked at one by one.
    """
    apos, bpos, n = apos.astype(np.int64), bpos.astype(np.int64), n.astype(np.int64)
    parts = []
    for j in (-1, 0, 1):  # what of a run lies in the panel before, its own and the next
        of = apos // panel + j
        lo, hi = np.maximum(apos, of * panel), np.minimum(apos + n, (of + 1) * panel + overlap)
        some = np.flatnonzero((of >= 0) & (hi > lo))
        parts.append((some, of[some], lo[some], hi[some]))
    some, of, lo, hi = (np.concatenate(x) for x in zip(*parts, strict=True))
    band = (apos[some] - bpos[some]) // width
    # Bands that can't have enough bases beside each other go, before sorting: sums by hash are never too small.
    bits, key = max(10, int(len(some)).bit_length() + 2), (aread[some], bread[some], comp[some].astype(np.int64) << 32 | of)
    slots = [(_mixed(*key, band + d) >> np.uint64(64 - bits)).astype(np.int64) for d in (-1, 0, 1)]
    sums = np.bincount(slots[1], weights=hi - lo + k - 1, minlength=1 << bits)
    enough = sums[slots[1]] + np.maximum(sums[slots[0]], sums[slots[2]]) >= least
    some, of, lo, hi, band = some[enough], of[enough], lo[enough], hi[enough], band[enough]
    order = np.lexsort((bpos[some], lo, band, of, comp[some], bread[some], aread[some]))
    some, of, lo, hi, band = some[order], of[order], lo[order], hi[order], band[order]
    x, y, c, b = aread[some], bread[some], comp[some], lo - apos[some] + bpos[some]
    first = _starts(x, y, c, of, band)
    if not len(first):
        first = np.zeros(0, np.int64)
    size = np.diff(first, append=len(lo))
    # Bases of A that a band's seeds cover.
    end = hi - 1 + k
    far = np.repeat(np.arange(len(first)), size) << 33
    upto = np.maximum.accumulate(end + far) - far
    before = np.concatenate([[0], upto[:-1]]) if len(upto) else upto
    before[first] = 0
    fresh = np.maximum(end - np.maximum(lo, before), 0)
    reduce_ = lambda f, v: f.reduceat(v, first) if len(first) else np.zeros(0, np.int64)
    own = reduce_(np.add, fresh)
    hx, hy, hc, ho, hb = x[first], y[first], c[first], of[first], band[first]
    beside = np.zeros(len(first), bool)
    beside[:-1] = (hx[1:] == hx[:-1]) & (hy[1:] == hy[:-1]) & (hc[1:] == hc[:-1]) & (ho[1:] == ho[:-1]) & (hb[1:] == hb[:-1] + 1)
    bases = own + np.where(beside, np.append(own[1:], 0), 0)
    found = np.flatnonzero(bases >= least)
    columns = {
        "aread": hx, "bread": hy, "comp": hc.astype(np.int32), "panel": ho, "band": hb, "a1": reduce_(np.minimum, lo), "a2": reduce_(np.maximum, end),
        "b1": reduce_(np.minimum, b), "b2": reduce_(np.maximum, b + hi - lo - 1 + k), "bases": bases,
    }
    last = first + size + np.where(beside, np.append(size[1:], 0), 0)
    return {name: v[found] for name, v in columns.items()}, (lo, b, hi - lo), first[found], last[found]


def bands_of(seqs: DataFrame, k: int, *, most: int = 10, **rule) -> DataFrame:
    """``bands`` of the ``seed_pairs`` of reads, without a row for a seed."""

    def handle(*runs):
        found = bands_of_runs(*runs, k, **rule)[0]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in found.values()], names=list(found))

    return pairs_mapped(seqs, k, handle, "aread long, bread long, comp int, panel long, band long, a1 long, a2 long, b1 long, b2 long, bases long", most=most)


def candidates(found: DataFrame, seqs: DataFrame, *, least: int = 100, seg: int = 100) -> DataFrame:
    """One alignment per band, the anchors' extent, where both lengths add up to 2 * ``least``:
    (aread, bread, comp, a1, a2, b1, b2, diffs, segments), segments the edit distances of A's
    segments of ``seg`` bases to the stretch of B beside them, diffs their sum.

    B's place beside a segment end is interpolated between the extreme anchors.
    """
    c = found.where(F.col("a2") - F.col("a1") + F.col("b2") - F.col("b1") >= 2 * least).select("aread", "bread", "comp", "a1", "a2", "b1", "b2")
    a = seqs.select(F.col("rid").alias("aread"), F.col("seq").alias("a_seq"))
    b = seqs.select(F.col("rid").alias("bread"), F.col("seq").alias("b_seq"))
    j = c.join(a, "aread").join(b, "bread").withColumn("b_side", F.when(F.col("comp") == 1, reverse_complement(F.col("b_seq"))).otherwise(F.col("b_seq")))

    def differences(s):
        lo, hi = F.greatest("a1", s * seg), F.least("a2", s * seg + seg)
        beside = lambda x: F.col("b1") + F.floor((x - F.col("a1")) * (F.col("b2") - F.col("b1")) / (F.col("a2") - F.col("a1")))
        cut = lambda text, x, y: F.substring(text, (x + 1).cast("int"), (y - x).cast("int"))
        return F.levenshtein(cut(F.col("a_seq"), lo, hi), cut(F.col("b_side"), beside(lo), beside(hi)))

    each = j.withColumn("segments", F.transform(F.sequence(floor_div(F.col("a1"), seg), floor_div(F.col("a2") - 1, seg)), differences))
    total = F.aggregate("segments", F.lit(0).cast("long"), lambda acc, d: acc + d)
    return each.select("aread", "bread", "comp", "a1", "a2", "b1", "b2", total.alias("diffs"), "segments")


def without_redundant(alignments: DataFrame) -> DataFrame:
    """Alignments (aread, bread, comp, a1, a2, b1, b2) that no other of their pair and strand contains in A and B; of equal ones one."""
    listed = alignments.groupBy("aread", "bread", "comp").agg(F.collect_set(F.struct("a1", "a2", "b1", "b2")).alias("v"))
    inside = lambda x, y: (x["a1"] >= y["a1"]) & (x["a2"] <= y["a2"]) & (x["b1"] >= y["b1"]) & (x["b2"] <= y["b2"]) & (x != y)
    kept = F.filter("v", lambda x: ~F.exists("v", lambda y: inside(x, y)))
    return listed.select("aread", "bread", "comp", F.explode(kept).alias("x")).select("aread", "bread", "comp", "x.*")


def tandem_hits(seqs: DataFrame, k: int, *, farthest: int = 200) -> DataFrame:
    """(rid, pos, period): a k-mer that recurs within ``farthest`` bases of its last occurrence in the read; no shuffle."""

    def run(batches):
        for batch in batches:
            # The pieces of a read that was cut overlap by k - 1 bases: its last places are carried on.
            held = None
            for row, pos, code, _ in _spots(batch.column(1), k):
                new = len(row)
                if held is not None and len(row) and held[0][-1] == row[0]:
                    row, pos, code = (np.concatenate(x) for x in zip(held, (row, pos, code), strict=True))
                order = np.lexsort((pos, code, row))
                r, p, c = row[order], pos[order], code[order]
                period = np.diff(p, prepend=-1)
                hit = np.concatenate([[False], (r[1:] == r[:-1]) & (c[1:] == c[:-1])]) & (period <= farthest) & (order >= len(row) - new)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(r[hit])), pa.array(p[hit]), pa.array(period[hit])], names=["rid", "pos", "period"])
                near = (row == row[-1]) & (pos > pos[-1] - farthest) if len(row) else np.zeros(0, bool)
                held = (row[near], pos[near], code[near]) if near.any() else None

    return seqs.select("rid", "seq").mapInArrow(run, "rid long, pos long, period long")


def kmer_lookup(seqs: DataFrame, k: int) -> DataFrame:
    """(rid, pos, n): each position's global k-mer count. Counts come by a join on the k-mer."""
    return _with_counts(kmer_codes(seqs, k), code_counts(seqs, k), k).select("rid", "pos", "n")


def window_classes(looked: DataFrame, *, noise: int, over: int, width: int = 250, expected: float = 0.5) -> DataFrame:
    """Per window of ``width`` positions: repeat where more than ``expected`` of its non-noise k-mers are over, else noise where most are noise."""
    per = looked.groupBy("rid", floor_div(F.col("pos"), width + 1).alias("w")).agg(F.count("*").alias("n"), F.count_if(F.col("n") < noise).alias("low"), F.count_if(F.col("n") >= over).alias("high"))
    kind = F.when(F.col("high") > expected * (F.col("n") - F.col("low")), "krepeats").when(F.col("low") * 2 > F.col("n"), "knoise")
    return per.select("rid", (F.col("w") * (width + 1)).alias("beg"), ((F.col("w") + 1) * (width + 1)).alias("fin"), kind.alias("track")).where("track is not null")


def dust(seqs: DataFrame, *, window: int = 64, threshold: float = 2.0) -> DataFrame:
    """Low-complexity intervals (rid, beg, fin): windows whose triplets repeat, sum c (c - 1) / 2 over the triplets' counts c, by more than
    ``threshold`` per triplet; overlapping windows merged. Each read is scanned where it lies, without a shuffle."""
    span = window - 2

    def scan(batches):
        for frame in batches:
            rows = []
            for rid, seq in zip(frame["rid"], frame["seq"], strict=True):
                codes = np.frombuffer((seq or "").encode(), np.uint8).astype(np.int32)
                t = codes[:-2] * 65536 + codes[1:-1] * 256 + codes[2:]
                if len(t) < span:
                    continue
                pairs = np.zeros(len(t) - span + 1, np.int64)  # equal pairs in the window that starts here
                for d in range(1, span):
                    run = np.concatenate([[0], np.cumsum(t[d:] == t[:-d])])
                    pairs += run[span - d : span - d + len(pairs)] - run[: len(pairs)]
                hit = np.flatnonzero(pairs > threshold * (span - 1))
                if len(hit):
                    new = np.flatnonzero(np.diff(hit, prepend=-(10**9)) > window)
                    last = np.append(new[1:] - 1, len(hit) - 1)
                    rows += [(rid, int(hit[i]), int(hit[j]) + window) for i, j in zip(new, last, strict=True)]
            yield pd.DataFrame(rows, columns=["rid", "beg", "fin"])

    return seqs.select("rid", "seq").mapInPandas(scan, "rid long, beg long, fin long")


def perfect_intervals(text: bytes, *, window: int = 64, threshold: float = 2.0) -> list[tuple[int, int]]:
    """Low-complexity intervals of a sequence, merged: every stretch of at most ``window`` bases whose triplets' equal pairs,
    divided by the triplets but one, are above ``threshold`` and not below those of any stretch inside it.

    All starts are looked at together, length by length, so the work is bases times window.
    """
    out: list[list[int]] = []
    for low in range(0, max(len(text) - 2, 0), RUN):  # starts from low on, and what they reach
        codes = np.frombuffer(text[low : low + RUN + window], np.uint8).astype(np.int32)
        t = codes[:-2] * 65536 + codes[1:-1] * 256 + codes[2:]
        n = len(t)
        if n < 2:
            continue
        # ``equal`` holds, for each end, how many of the m triplets before it are like it.
        equal, pairs, best = np.zeros(n, np.int32), np.zeros(n, np.int32), np.full(n, -1.0)
        longest = np.zeros(n, np.int32)
        for m in range(1, min(window - 2, n)):  # stretches of m + 1 triplets
            equal[m:] += t[m:] == t[:-m]
            size = n - m
            pairs = pairs[:size] + equal[m:]
            score = pairs / m
            inner = np.maximum(best[:size], best[1 : size + 1])
            longest[:size][(score > threshold) & (score >= inner)] = m + 1
            best = np.maximum(inner, score)
        for i in np.flatnonzero(longest[:RUN]).tolist():
            beg, fin = low + i, low + i + int(longest[i]) + 2
            if out and beg <= out[-1][1]:
                out[-1][1] = max(out[-1][1], fin)
            else:
                out.append([beg, fin])
    return [(b, e) for b, e in out]


def dust_perfect(seqs: DataFrame, *, window: int = 64, threshold: float = 2.0, shortest: int = 10) -> DataFrame:
    """(rid, beg, fin): ``perfect_intervals`` of every read, those of ``shortest`` bases or more; each read is scanned where it lies."""

    def scan(batches):
        for frame in batches:
            rows = [(rid, b, e) for rid, seq in zip(frame["rid"], frame["seq"], strict=True) for b, e in perfect_intervals((seq or "").encode(), window=window, threshold=threshold) if e - b >= shortest]
            yield pd.DataFrame(rows, columns=["rid", "beg", "fin"])

    return seqs.select("rid", "seq").mapInPandas(scan, "rid long, beg long, fin long")

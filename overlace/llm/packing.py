"""Best-fit packing with certified bin counts.

Documents become token sequences; only those longer than a bin are cut. The pieces are
dealt to partitions of a bounded number of pieces, each packed by best-fit decreasing.
Dual-feasible functions give a lower bound on the bins of each partition: a partition
that uses no more is certified. While the bins of all partitions exceed the bound of all
pieces, those with gaps exchange documents: the pieces of the uncertified partitions' bins
that aren't full are dealt anew and best-fit decreasing runs again; a round that saves no
bin is undone. Then the open bins of all partitions take part, in partitions that grow up
to ``MOST`` pieces. It ends at the bound of all pieces or where no round saves a bin.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from overlace.llm import kernels as K
from overlace.llm.common import discard, map_batches, stored

CAPACITY, END_ID = 4096, 1
#: Pieces in one partition, about, and at most; parts of texts that a task remembers; bytes of text, and new parts, handled at a time.
GROUP, MOST, REMEMBERED, TEXT, NEW = 40_000, 640_000, 300_000, 512 << 10, 4096
#: The steps of the tokenizers whose texts ``parts`` may cut.
STEPS = (
    r"""Sequence(normalizers=[NFC(), Replace(pattern=Regex("\s+"), content=" "), Lowercase()])""",
    r"""Sequence(pretokenizers=[Split(pattern=Regex("'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"), behavior=Removed, invert=True), ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=False)])""",
)


#: Kinds of bytes: 0 white space, 1 letters a-z (and, by ``parts``, the Latin-1 letters), 3 ASCII punctuation but the apostrophe, 2 the rest.
KIND = np.full(256, 2, np.uint8)
KIND[:128][[not chr(b).isalnum() and b != 39 for b in range(128)]] = 3
KIND[ord("a") : ord("z") + 1] = 1
KIND[K.SPACE] = 0
#: Byte-level tokenizers write the bytes that print as themselves, the others as 256, 257, ... in order.
SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_CHARS = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in SHOWN)}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def parts(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes; start, end and row of each part of a text; whether it's letters only.

    Parts end at white space, and between a letter and ASCII punctuation other than the
    apostrophe: places that no token of the tokenizer spans, so a text's ids are those of
    its parts in order.
    """
    data = K.LOWER[data]
    kind = KIND[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]  # the signs for times and divided by
    upper = lead[(data[lead + 1] < 0x9F)] + 1
    data[upper] += 0x20
    kind[lead] = kind[lead + 1] = 1
    new = np.ones(len(data), bool)
    new[1:] = (kind[:-1] == 0) | (kind[:-1] * kind[1:] == 3)
    new[at[(at < len(data))]] = True
    starts = np.flatnonzero(new & (kind != 0))
    last = np.ones(len(data), bool)
    last[:-1] = new[1:] | (kind[1:] == 0)
    ends = np.flatnonzero(last & (kind != 0)) + 1
    others = np.concatenate([[0], np.cumsum(kind != 1)])
    return data, starts, ends, np.searchsorted(at[1:], starts, side="right"), others[ends] == others[starts]


class Parts:
    """Ids of parts of texts met so far, by hash; the bytes are kept and compared, too."""

    def __init__(self, path: str, end_id: int = END_ID):
        from tokenizers import Tokenizer

        self.tokenizer, self.end_id = Tokenizer.from_file(path), end_id
        #: Bytes that every id fits in.
        self.width = 2 if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        self.model = self.tokenizer.model
        self.cuts = (str(self.tokenizer.normalizer), str(self.tokenizer.pre_tokenizer)) == STEPS
        added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile(b"|".join(map(re.escape, added))) if added else None
        self.clear()

    def clear(self) -> None:
        self.hashes, self.starts, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.array([self.end_id], np.uint32)
        self.spelt, self.spelt_at, self.sizes = np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def made(self, raw: bytes, starts: np.ndarray, ends: np.ndarray, letters: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts and how many each has."""
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for low in range(0, len(starts), NEW):
            spans = zip(starts[low : low + NEW].tolist(), ends[low : low + NEW].tolist(), strict=True)
            if letters:
                found = [[t.id for t in self.model.tokenize(raw[i:j].decode("latin-1").translate(BYTE_CHARS))] for i, j in spans]
            else:
                found = [self.tokenizer.encode(raw[i:j].decode(), add_special_tokens=False).ids for i, j in spans]
            counts.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter(chain.from_iterable(found), np.uint32, int(counts[-1].sum())))
        return np.concatenate(ids), np.concatenate(counts)

    def places(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, letters: np.ndarray, data: np.ndarray) -> np.ndarray:
        """The place of each distinct part among those met; new ones are tokenised."""
        if len(self.hashes) + len(hashes) > REMEMBERED:
            self.clear()
        at = np.searchsorted(self.hashes, hashes)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == hashes[known]
        if not known.all():
            raw, new = data.tobytes(), np.flatnonzero(~known)
            plain, other = new[letters[new]], new[~letters[new]]
            (ids, counts), (more, further) = self.made(raw, starts[plain], ends[plain], True), self.made(raw, starts[other], ends[other], False)
            counts = np.concatenate([counts, further])
            begin = len(self.ids) + np.cumsum(counts) - counts
            self.ids = np.concatenate([self.ids, ids, more])
            new = np.concatenate([plain, other])
            order = np.argsort(hashes[new])
            where = at[new][order]
            self.starts, self.counts = np.insert(self.starts, where, begin[order]), np.insert(self.counts, where, counts[order])
            size = ends[new] - starts[new]
            spelt_at = len(self.spelt) + np.cumsum(size) - size
            self.spelt = np.concatenate([self.spelt, data[K.ranges(starts[new], size)]])
            self.spelt_at, self.sizes = np.insert(self.spelt_at, where, spelt_at[order]), np.insert(self.sizes, where, size[order])
            self.hashes = np.insert(self.hashes, where, hashes[new][order])
            at = np.searchsorted(self.hashes, hashes)
        return at

    def same(self, at: np.ndarray, starts: np.ndarray, ends: np.ndarray, data: np.ndarray) -> bool:
        """Whether every part has the bytes of the remembered part at its place."""
        size = ends - starts
        return bool((self.sizes[at] == size).all()) and np.array_equal(self.spelt[K.ranges(self.spelt_at[at], size)], data[K.ranges(starts, size)])

    def whole(self, data: np.ndarray) -> np.ndarray:
        """Ids of one text by the library alone, and the end."""
        return np.array([*self.tokenizer.encode(data.tobytes().decode(), add_special_tokens=False).ids, self.end_id], np.uint32)

    def encode(self, column) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, offsets) of runs of rows; each row ends with the end id.

        Texts that hold an added token's string, and all texts of a tokenizer of other
        ``STEPS``, are left to the library as a whole.
        """
        data, at = K.text_bytes(column)
        apart = np.ones(len(at) - 1, bool)
        if self.cuts:
            hits = [m.start() for m in self.special.finditer(data)] if self.special and len(data) else []
            apart = np.zeros(len(at) - 1, bool)
            apart[np.searchsorted(at[1:], hits, side="right")] = True
        for first, end in _runs(apart):
            if apart[first]:
                for i in range(first, end):
                    ids = self.whole(data[at[i] : at[i + 1]])
                    yield i, ids, np.array([0, len(ids)])
            else:
                for low, ids, where in self.by_parts(data[at[first] : at[end]], at[first : end + 1] - at[first]):
                    yield first + low, ids, where

    def by_parts(self, data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for low, high, raw, where in K.chunks(data, at, TEXT):
            part, starts, ends, rows, letters = parts(raw, where)
            hashes, first, which = np.unique(K.strong_hashes(part, starts, ends), return_index=True, return_inverse=True)
            place, n = self.places(hashes, starts[first], ends[first], letters[first], part), high - low
            if not self.same(place[which], starts, ends, part):  # unlike parts of one hash
                for i in range(n):
                    ids = self.whole(raw[where[i] : where[i + 1]])
                    yield low + i, ids, np.array([0, len(ids)])
                continue
            begin, count = self.starts[place], self.counts[place]
            # Each row's parts in order, then its end.
            line_begin, line_count = np.zeros(len(rows) + n, np.int64), np.ones(len(rows) + n, np.int64)
            place = np.arange(len(rows)) + rows
            line_begin[place], line_count[place] = begin[which], count[which]
            last = np.cumsum(np.bincount(rows, minlength=n)) + np.arange(n)
            ids = self.ids[K.ranges(line_begin, line_count)]
            yield low, ids, np.concatenate([[0], np.cumsum(line_count)[last]])


def _runs(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, end) of each run of equal flags."""
    edges = np.concatenate([[0], np.flatnonzero(flags[1:] != flags[:-1]) + 1, [len(flags)]]) if len(flags) else [0]
    yield from zip(edges[:-1], edges[1:], strict=True)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        words = Parts(tokenizer)
        for batch in batches:
            for low, ids, at in words.encode(batch.column(1)):
                size = np.diff(at)
                number = -(-size // capacity)
                row = np.repeat(np.arange(len(size)), number)
                piece = K.ranges(np.zeros(len(size), np.int64), number)
                start = piece * capacity
                length = np.minimum(size[row] - start, capacity)
                raw = memoryview(ids.astype("<u4").tobytes())
                begin = (at[row] + start) * 4
                crc = [zlib.crc32(raw[i:j]) for i, j in zip(begin.tolist(), (begin + length * 4).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(low + row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each piece, and each bin's gap. The bins' gaps are kept as the bits
    of one integer, so the tightest bin that fits is its lowest bit from the length on."""
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps, bits = [], 0
    bin_of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fits = bits >> length
        if fits:
            gap = (fits & -fits).bit_length() - 1 + length
            b = open_bins[gap].pop()
            if not open_bins[gap]:
                bits ^= 1 << gap
        else:
            gap, b = capacity, len(gaps)
            gaps.append(gap)
        bin_of[i], offset[i] = b, capacity - gap
        gap -= length
        gaps[b] = gap
        if gap:
            open_bins[gap].append(b)
            bits |= 1 << gap
    return bin_of, offset, np.array(gaps, np.int64)


def lower_bound(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """The largest lower bound on the number of bins by two families of dual-feasible functions."""
    order = np.argsort(lengths)
    x, n = lengths[order].astype(np.int64), counts[order].astype(np.int64)
    bulk, number = np.concatenate([[0], np.cumsum(x * n)]), np.concatenate([[0], np.cumsum(n)])
    best = -(-int(bulk[-1]) // capacity)
    # Pieces above capacity - cut count whole, those below cut not at all, the rest by length.
    cut = np.unique(np.concatenate([[0], x[2 * x <= capacity]]))
    high, low = np.searchsorted(x, capacity - cut, side="right"), np.searchsorted(x, cut, side="left")
    high = np.maximum(high, low)
    best = max(best, int(((number[-1] - number[high]) + -(-(bulk[high] - bulk[low]) // capacity)).max(initial=0)))
    for k in range(1, 21):  # lengths rounded to multiples of capacity / k
        whole = x * (k + 1) % capacity == 0
        doubled = np.where(whole, x * (k + 1) * k, (x * (k + 1) // capacity) * (k + 1) * capacity)  # in units of capacity * k * (k + 1)
        best = max(best, -(-int((doubled * n).sum()) // (capacity * k * (k + 1))))
    return best


def _pack_group(capacity: int, round_: int):
    """Packs one partition; ``certified`` says that its bins are as few as its own lower bound."""

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        lengths = rows["length"].to_numpy(np.int64)
        bin_of, offset, gaps = best_fit_decreasing(lengths, capacity)
        certified = len(gaps) <= lower_bound(*np.unique(lengths, return_counts=True), capacity)
        return rows.assign(_round=round_, _group=int(key[0]), _bin=bin_of, offset=offset, gap=gaps[bin_of], certified=certified)

    return run


def total_bound(items: DataFrame, capacity: int = CAPACITY) -> int:
    """The lower bound on the bins of all of ``items``, from at most ``capacity`` counts of lengths."""
    lengths = items.groupBy("length").count().toPandas()
    return lower_bound(lengths["length"].to_numpy(np.int64), lengths["count"].to_numpy(np.int64), capacity)


def pack_pieces(items: DataFrame, capacity: int = CAPACITY, *, group: int = GROUP, most: int = MOST) -> DataFrame:
    """Give every row of ``items`` (a column ``length`` of 1 to ``capacity``) a sequence_id and an
    offset; ``certified`` says that the partition that packed it met its own bound.

    ``items`` must be a table, so that a task that runs again reads the same rows.
    """
    names = items.columns
    # A row's number deals it out, so that equal rows don't meet in one partition.
    numbered = stored(items.withColumn("_row", F.monotonically_increasing_id()))
    bound = total_bound(numbered, capacity)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema)
    schema = f"{fields}, _part long, _round long, _group long, _bin long, offset long, gap long, certified boolean"

    def packed(part: DataFrame, groups: int, round_: int) -> DataFrame:
        dealt = part.withColumn("_part", F.pmod(F.xxhash64(F.lit(round_), "_row"), F.lit(groups)))
        return stored(dealt.groupBy("_part").applyInPandas(_pack_group(capacity, round_), schema).drop("_part"))

    def counts(df: DataFrame) -> tuple[int, int, int]:
        """Bins; pieces in open bins; those of uncertified partitions."""
        open_ = F.col("gap") > 0
        row = df.agg(F.sum((F.col("offset") == 0).cast("long")).alias("bins"), F.sum(open_.cast("long")).alias("open"), F.sum((open_ & ~F.col("certified")).cast("long")).alias("loose")).first()
        return row["bins"] or 0, row["open"] or 0, row["loose"] or 0

    number = numbered.count()
    current, closed = packed(numbered, max(1, -(-number // group)), 0), []
    used, open_, loose = counts(current)
    size, everyone, round_ = group, False, 0
    while used > bound and open_ > 1:
        everyone = everyone or loose == 0
        taken = (F.col("gap") > 0) & (F.lit(everyone) | ~F.col("certified"))
        pool, n = current.where(taken), open_ if everyone else loose
        groups = max(1, -(-n // size))
        round_ += 1
        again = packed(pool.select(*numbered.columns), groups, round_)
        before, (after, *_) = pool.where("offset = 0").count(), counts(again)
        if after < before:
            merged = stored(current.where(~taken).where("gap > 0").unionByName(again))
            closed.append(current.where("gap = 0"))
            used -= before - after
            _, open_, loose = counts(merged)
            current = merged
        elif not everyone:
            everyone = True
        elif groups == 1 or size >= most:
            break
        else:
            size = min(size * 4, most)
        discard(again)
    for df in closed:
        current = current.unionByName(df)
    most_groups, most_bins = current.agg(F.max("_group"), F.max("_bin")).first()
    number_of = (F.col("_round") * ((most_groups or 0) + 1) + F.col("_group")) * ((most_bins or 0) + 1) + F.col("_bin")
    return current.select(*names, number_of.alias("sequence_id"), "offset", "certified")


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: bins, bound (no packing of these pieces has fewer) and gap, the difference."""
    bound = total_bound(packed, capacity)
    bins = packed.agg(F.coalesce(F.sum((F.col("offset") == 0).cast("long")), F.lit(0)).alias("bins"))
    return bins.select("bins", F.lit(bound).cast("long").alias("bound"), (F.col("bins") - bound).alias("gap"))


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, **options) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    ``docs``: doc_id, text and any other columns. Returns one row per piece: doc_id,
    piece, start, length, ids_crc32, sequence_id, offset, certified.

    A document is its tokenizer's ids and then id 1. Null text counts as empty: id 1
    alone. Special tokens' strings in a text become their ids, as the library reads them.
    Repeated rows are each packed, null doc_ids too. Of pieces that fit equally well, any
    order. An empty table gives an empty result.
    """
    return pack_pieces(pieces(docs, tokenizer or default_tokenizer(), capacity), capacity, **options)

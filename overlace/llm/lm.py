"""LM scoring: context-tree weighting over bytes, beside a unigram word baseline.

**Model.** Each byte of the lower-cased text (and an end symbol, byte 0xFF) is
decomposed into eight binary decisions. Every node of that binary decision tree has a
context tree over the preceding ``DEPTH`` bytes; each context keeps a Krichevsky-Trofimov
estimate, and the estimates of all depths 0 to ``DEPTH`` are mixed with the context-tree
weights. KT estimates depend on counts alone, so the whole training corpus enters as one
distributed count of codes, a code being a context and the byte that follows. The codes of
all documents are in that table, those that were never trained on with the count 0.

The trees are built in Spark tasks, one for the contexts that end in the same two bytes:
bottom-up, a context's weighted probability from those of its longer ones; the sums for
contexts of one byte and none, at most 65,280 rows, are joined on the driver; top-down,
the probability of every code. An ending of more than ``SPLIT`` codes is split by one byte
more, and again, up to a whole context, which has 256 codes; the nodes between a split
ending and its parts are rows of tables, summed on the way up and joined on the way down.
The table of codes grows with the corpus. While it is small
it is broadcast; beyond, documents are dealt to bundles of bounded size, and the distinct
codes of each bundle are joined with the table by a shuffle.

**Baseline.** Word counts of the training documents. Words of at least a threshold
count, at most ``TOP_WORDS`` of them, go to the scorers; the document's other words are
joined with the full counts by a shuffle, so no vocabulary is cut off.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from overlace.llm import kernels as K
from overlace.llm.common import crc_mod, discard, map_batches, met, stored

DEPTH = 5
END = 255
TOP_WORDS = 1 << 17
#: Codes up to which the table is broadcast (12 bytes each); bytes of text in a bundle, about.
TOP_CODES, BUNDLE = 5_000_000, 16 << 20
#: Codes of one ending up to which one task builds its trees.
SPLIT = 500_000
#: Distinct codes that a task holds before it merges them; bits of a row's number beside a code; bytes of text in a chunk.
HELD, ROW_BITS, CHUNK = 2_000_000, 15, 1 << 20


def codes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """context * 256 + byte at every position of every row, its end symbol included; row offsets.

    The byte before is the context's last one. Positions before a row's first byte count
    as the end symbol.
    """
    n = len(at) - 1
    ends = at[1:] + np.arange(n)
    line = np.full(len(data) + n, END, np.uint8)
    inside = np.ones(len(line), bool)
    inside[ends] = False
    line[inside] = K.LOWER[data]
    first = at[:-1] + np.arange(n)
    code = line.astype(np.int64)
    for back in range(1, DEPTH + 1):
        past = np.full(len(line), END, np.int64)
        past[back:] = line[:-back]
        for j in range(back):  # the row's first bytes: no look into the row before
            place = first + j
            past[place[place < ends + 1]] = END
        code |= past << 8 * back
    return code, np.append(first, len(line))


def _merged(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, ascending, and their summed counts."""
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    lead = np.flatnonzero(np.diff(code, prepend=-1))
    return code[lead], np.add.reduceat(n, lead) if len(lead) else n


def count_codes(batches):
    """(code, n) of the codes of texts, and how often each occurs where ``learn`` is true; batches of (text, learn)."""
    held, size = [], 0
    for batch in batches:
        learn = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        for low, high, part, where in K.chunks(*K.text_bytes(batch.column(0)), CHUNK):
            code, at = codes(part, where)
            flagged = np.sort(code << 1 | np.repeat(learn[low:high], np.diff(at)))
            lead = np.flatnonzero(np.diff(flagged, prepend=-1))
            flagged, n = flagged[lead], np.diff(np.append(lead, len(flagged)))
            held.append((flagged >> 1, n * (flagged & 1)))
            size += len(lead)
            if size > HELD:
                held = [_merged(*(np.concatenate(x) for x in zip(*held, strict=True)))]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield from held
                    held, size = [], 0
    if held:
        yield _merged(*(np.concatenate(x) for x in zip(*held, strict=True)))


def _kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return _log_gamma_half(zeros) + _log_gamma_half(ones) - _log_factorial(zeros + ones)


def _log_factorial(n: np.ndarray) -> np.ndarray:
    """log(n!) by Stirling's series, exact sums below 16."""
    small = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 16)))])
    x = np.maximum(n, 16).astype(np.float64) + 1
    series = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return np.where(n < 16, small[np.minimum(n, 15)], series)


def _log_gamma_half(n: np.ndarray) -> np.ndarray:
    """log of 1/2 * 3/2 * ... * (n - 1/2), n factors."""
    small = np.concatenate([[0.0], np.cumsum(np.log(np.arange(16) + 0.5))])
    x = np.maximum(n, 16).astype(np.float64) + 0.5
    series = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 0.5 * np.log(np.pi)
    return np.where(n < 16, small[np.minimum(n, 15)], series)


def _mask(depth: int) -> int:
    return (1 << 8 * depth) - 1


def _tree(code: np.ndarray, n: np.ndarray, least: int) -> tuple[np.ndarray, list[dict]]:
    """The binary decisions of the codes, eight each, and the nodes (context, decision) of depths ``DEPTH`` down to ``least``.

    A level has keys (context * 256 + decision; decision 2**d + p is the one taken after
    the d leading bits p), zeros, ones, ``weighted`` (log of the weighted probability),
    ``share`` (the longer contexts' part in it) and ``child``, the place of each node of the
    level below it in ``levels`` among its own. Returns (node of each decision, levels).
    """
    byte, context = code & 255, code >> 8
    step = np.arange(8)
    decision = (1 << step) | (byte[:, None] >> (8 - step))
    bit = (byte[:, None] >> (7 - step)) & 1
    keys, node = np.unique((context[:, None] << 8 | decision).ravel(), return_inverse=True)
    count = np.repeat(n, 8)
    ones = np.bincount(node, weights=count * bit.ravel(), minlength=len(keys)).astype(np.int64)
    zeros = np.bincount(node, weights=count, minlength=len(keys)).astype(np.int64) - ones
    levels = [{"keys": keys, "zeros": zeros, "ones": ones, "weighted": _kt(zeros, ones), "share": np.zeros(len(keys))}]
    for depth in range(DEPTH - 1, least - 1, -1):
        below = levels[-1]
        keys, child = np.unique(((below["keys"] >> 8) & _mask(depth)) << 8 | (below["keys"] & 255), return_inverse=True)
        add = lambda x: np.bincount(child, weights=x, minlength=len(keys))  # noqa: B023, E731
        zeros, ones, longer = add(below["zeros"]).astype(np.int64), add(below["ones"]).astype(np.int64), add(below["weighted"])
        kt = _kt(zeros, ones)
        levels.append({"keys": keys, "zeros": zeros, "ones": ones, "weighted": np.logaddexp(kt, longer) - np.log(2), "share": 1 / (1 + np.exp(np.clip(kt - longer, -700, 700))), "child": child})
    return node, levels


def _down(level: dict, made: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The mixture's part above a level (``made``, the probability of a one so far, and ``rest``, the weight left) taken below it."""
    p = (level["ones"] + 0.5) / (level["zeros"] + level["ones"] + 1)
    return made + rest * (1 - level["share"]) * p, rest * level["share"]


def sums_of_two(table: pa.Table) -> pa.Table:
    """(context, decision, zeros, ones, weighted) of contexts of one byte, as far as the codes of one ending of two bytes go."""
    top = _tree(table.column("code").to_numpy(), table.column("n").to_numpy(), 2)[1][-1]
    return pa.table({"context": (top["keys"] >> 8) & 255, "decision": top["keys"] & 255, "zeros": top["zeros"], "ones": top["ones"], "weighted": top["weighted"]})


def upper(context: np.ndarray, decision: np.ndarray, zeros: np.ndarray, ones: np.ndarray, longer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``made`` and ``rest`` below the contexts of one byte, arrays [last byte, decision], from the sums over those of two."""
    level = {"zeros": np.zeros((256, 256), np.int64), "ones": np.zeros((256, 256), np.int64), "below": np.zeros((256, 256))}
    for name, values in (("zeros", zeros), ("ones", ones), ("below", longer)):
        level[name][context, decision] = values

    def weigh(level: dict) -> None:
        kt = _kt(level["zeros"], level["ones"])
        level["share"] = 1 / (1 + np.exp(np.clip(kt - level["below"], -700, 700)))
        level["weighted"] = np.logaddexp(kt, level["below"]) - np.log(2)

    weigh(level)
    root = {"zeros": level["zeros"].sum(0), "ones": level["ones"].sum(0), "below": level["weighted"].sum(0)}
    weigh(root)
    return _down(level, *(np.broadcast_to(x, (256, 256)) for x in _down(root, np.zeros(256), np.ones(256))))


def log_probabilities(code: np.ndarray, n: np.ndarray, made: np.ndarray, rest: np.ndarray, depth: int = 2) -> np.ndarray:
    """log10 of the probability of each code's byte in its context, of the codes of one ending of ``depth`` bytes.

    ``made`` and ``rest`` are what the shorter contexts leave: arrays [last byte, decision] for two bytes, [decision] for more.
    """
    node, levels = _tree(code, n, depth)
    top = levels[-1]["keys"]
    place = ((top >> 8) & 255, top & 255) if depth == 2 else top & 255
    m, r = made[place], rest[place]
    for level in reversed(levels[1:]):
        m, r = _down(level, m, r)
        m, r = m[level["child"]], r[level["child"]]
    one = _down(levels[0], m, r)[0][node].reshape(-1, 8)
    bit = ((code[:, None] & 255) >> (7 - np.arange(8))) & 1
    return np.log10(np.where(bit == 1, one, 1 - one)).sum(1)


def _ending(depth: int):
    return F.shiftright("code", 8).bitwiseAND(F.lit(_mask(depth)))


def with_endings(counted: DataFrame) -> tuple[DataFrame, bool]:
    """The codes with the ending (depth in bytes, value) whose task takes them, and whether any ending was split.

    An ending of more than ``SPLIT`` codes gives way to those of one byte more.
    """
    rows, split = counted.withColumn("depth", F.lit(2)), False
    for depth in range(2, DEPTH):
        large = stored(rows.where(F.col("depth") == depth).groupBy(_ending(depth).alias("large")).agg(F.count("*").alias("codes")).where(F.col("codes") > SPLIT).select("large"))
        if large.isEmpty():
            discard(large)
            break
        split = True
        found = met(rows.withColumn("large", _ending(depth)), large.withColumn("deeper", F.lit(depth + 1)), "large", "left")
        rows = found.withColumn("depth", F.coalesce(F.when(F.col("depth") == depth, F.col("deeper")), F.col("depth"))).drop("large", "deeper")
    return rows.withColumn("ending", F.shiftright("code", 8).bitwiseAND(F.expr("shiftleft(1L, 8 * depth) - 1"))), split


def sums_of_ending(table: pa.Table) -> pa.Table:
    """The nodes (depth, context, decision, zeros, ones, weighted) of the context that all codes of a task end in."""
    depth = table.column("depth")[0].as_py()
    top = _tree(table.column("code").to_numpy(), table.column("n").to_numpy(), depth)[1][-1]
    whole = np.full(len(top["keys"]), depth, np.int32)
    return pa.table({"depth": whole, "context": (top["keys"] >> 8) & _mask(depth), "decision": top["keys"] & 255, "zeros": top["zeros"], "ones": top["ones"], "weighted": top["weighted"]})


def _columns(batch: pa.RecordBatch) -> dict:
    return {name: batch.column(i).to_numpy(zero_copy_only=False) for i, name in enumerate(batch.schema.names)}


def split_nodes(tops: DataFrame) -> dict[int, DataFrame]:
    """Depth to nodes (context, decision, zeros, ones, weighted, share) of the contexts that were split, from those of their parts."""

    def weigh(batches):
        for batch in batches:
            c = _columns(batch)
            kt, longer = _kt(c["zeros"], c["ones"]), c.pop("longer")
            yield pa.RecordBatch.from_pydict({**c, "weighted": np.logaddexp(kt, longer) - np.log(2), "share": 1 / (1 + np.exp(np.clip(kt - longer, -700, 700)))})

    columns, nodes = ["context", "decision", "zeros", "ones", "weighted"], {}
    below = tops.where(F.col("depth") == DEPTH).select(columns)
    for depth in range(DEPTH - 1, 1, -1):
        sums = below.groupBy(F.col("context").bitwiseAND(F.lit(_mask(depth))).alias("context"), "decision").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("longer"))
        nodes[depth] = stored(map_batches(sums, weigh, "context long, decision long, zeros long, ones long, weighted double, share double"))
        below = nodes[depth].select(columns).unionByName(tops.where(F.col("depth") == depth).select(columns))
    return nodes


def left_by_split(nodes: dict[int, DataFrame], tops: DataFrame, made: np.ndarray, rest: np.ndarray) -> DataFrame:
    """(depth, ending, decision, made, rest): what the shorter contexts leave to each part of a split ending."""

    def down(batches):
        for batch in batches:
            c = _columns(batch)
            if "made" not in c:
                c["made"], c["rest"] = (x[c["context"] & 255, c["decision"]] for x in (made, rest))
            m, r = _down(c, c["made"], c["rest"])
            yield pa.RecordBatch.from_pydict({"parent": c["context"], "decision": c["decision"], "made": m, "rest": r})

    schema, left = "parent long, decision long, made double, rest double", {}
    for depth in range(2, DEPTH):
        rows = nodes[depth].drop("weighted")
        if depth > 2:
            rows = rows.withColumn("parent", F.col("context").bitwiseAND(F.lit(_mask(depth - 1)))).join(left[depth - 1], ["parent", "decision"]).drop("parent")
        left[depth] = stored(map_batches(rows, down, schema))
    given = None
    for depth, rows in left.items():
        part = tops.where(F.col("depth") == depth + 1).withColumn("parent", F.col("context").bitwiseAND(F.lit(_mask(depth)))).join(rows, ["parent", "decision"])
        part = part.select("depth", F.col("context").alias("ending"), "decision", "made", "rest")
        given = part if given is None else given.unionByName(part)
    return given


def code_table(docs: DataFrame) -> DataFrame:
    """(code, logp) of every code of the documents (text, learn), learned from the rows where ``learn`` is true."""

    def count(batches):
        for found, n in count_codes(batches):
            for low in range(0, len(found), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(found[low : low + (1 << 16)]), pa.array(n[low : low + (1 << 16)])], names=["code", "n"])

    counted = stored(map_batches(docs.select("text", "learn"), count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")))
    rows, split = with_endings(counted)
    whole, parts = rows.where("depth = 2").drop("depth").groupBy("ending"), rows.where("depth > 2").groupBy("depth", "ending")
    sums = whole.applyInArrow(sums_of_two, "context long, decision long, zeros long, ones long, weighted double")
    if split:
        tops = stored(parts.applyInArrow(sums_of_ending, "depth int, context long, decision long, zeros long, ones long, weighted double"))
        nodes = split_nodes(tops)
        sums = sums.unionByName(nodes[2].withColumn("context", F.col("context").bitwiseAND(255)).drop("share"))
    top = sums.groupBy("context", "decision").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("weighted")).toPandas()  # at most 256 * 255 rows
    made, rest = upper(*(top[c].to_numpy() for c in ("context", "decision", "zeros", "ones", "weighted")))

    def solve(table: pa.Table) -> pa.Table:
        code = table.column("code").to_numpy()
        return pa.table({"code": code, "logp": log_probabilities(code, table.column("n").to_numpy(), made, rest).astype(np.float32)})

    def solve_part(table: pa.Table, given: pa.Table) -> pa.Table:
        code, at = table.column("code").to_numpy(), given.column("decision").to_numpy()
        m, r = np.zeros(256), np.zeros(256)
        m[at], r[at] = given.column("made").to_numpy(), given.column("rest").to_numpy()
        return pa.table({"code": code, "logp": log_probabilities(code, table.column("n").to_numpy(), m, r, table.column("depth")[0].as_py()).astype(np.float32)})

    schema = "code long, logp float"
    solved = whole.applyInArrow(solve, schema)
    if split:
        solved = solved.unionByName(parts.cogroup(left_by_split(nodes, tops, made, rest).groupBy("depth", "ending")).applyInArrow(solve_part, schema))
    return stored(solved)


class Lookup:
    """The values of codes, which are all in the table. Codes are asked for in ascending order."""

    def __init__(self, code: np.ndarray, logp: np.ndarray):
        order = np.argsort(code)
        self.code, self.logp = code[order], logp[order]

    def __call__(self, code: np.ndarray) -> np.ndarray:
        return self.logp[np.searchsorted(self.code, code)]


def log10_probability(data: np.ndarray, at: np.ndarray, lookup) -> np.ndarray:
    """log10 of the model's probability of each row, its end symbol included.

    Codes are sorted together with their rows, so that each distinct one is looked up once.
    """
    code, where = codes(data, at)
    n, out = len(where) - 1, np.zeros(len(where) - 1)
    for low in range(0, n, 1 << ROW_BITS):  # a code takes 48 bits
        high = min(n, low + (1 << ROW_BITS))
        row = np.repeat(np.arange(high - low), np.diff(where[low : high + 1]))
        packed = np.sort(code[where[low] : where[high]] << ROW_BITS | row)
        distinct = packed >> ROW_BITS
        lead = np.flatnonzero(np.diff(distinct, prepend=-1))
        each = np.repeat(lookup(distinct[lead]), np.diff(np.append(lead, len(packed))))
        out[low:high] = np.bincount(packed & ((1 << ROW_BITS) - 1), weights=each, minlength=high - low)
    return out


def _rows_of_words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Row of each word, and the words."""
    starts, ends, rows = K.words(data, at, K.SPACE)
    size = ends - starts
    where = np.zeros(len(size) + 1, np.int32)
    np.cumsum(size, out=where[1:])
    line = data[K.ranges(starts, size)]
    return rows, pa.Array.from_buffers(pa.string(), len(size), [None, pa.py_buffer(where), pa.py_buffer(line)])


COLUMNS = ("row", "doc_id", "word", "n_tokens", "n_known", "base", "score", "bytes")


def _scorer(ids: pa.DataType, known: pa.Array, c_of: np.ndarray, n_end: int, below: float):
    """A function of (first row number, doc_ids, texts, lookup) that yields batches of ``COLUMNS``: one
    row a text and one for each of its words that isn't ``known``, with the word's count in n_tokens."""
    types = (pa.int64(), ids, pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64())

    def batch_of(n: int, *values) -> pa.RecordBatch:
        made = [pa.nulls(n, t) if x is None else x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, t) for x, t in zip(values, types, strict=True)]
        return pa.RecordBatch.from_arrays([x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in made], names=list(COLUMNS))

    def run(row: int, doc_ids, texts, lookup):
        for low, high, part, where in K.chunks(*K.text_bytes(texts), CHUNK):
            n = high - low
            lower = K.LOWER[part]
            rows, text = _rows_of_words(lower, where)
            coded = text.dictionary_encode()
            which = coded.indices.to_numpy()
            c = c_of[pc.fill_null(pc.index_in(coded.dictionary, known), len(known)).to_numpy()[which]]
            hit = c > 0
            tokens = np.bincount(rows, minlength=n) + 1
            base = K.row_sums(np.log10(c + 0.5) * hit, rows, n) + np.log10(n_end + 0.5) - tokens * below
            yield batch_of(
                n, row + low + np.arange(n), doc_ids.slice(low, n), None, tokens, K.row_sums(hit, rows, n).astype(np.int64) + (n_end > 0), base,
                log10_probability(part, where, lookup), np.diff(where) + 1,
            )
            key, times = np.unique(rows[~hit] * len(coded.dictionary) + which[~hit], return_counts=True)
            if len(key):
                rare, word = key // len(coded.dictionary), key % len(coded.dictionary)
                yield batch_of(len(key), row + low + rare, None, coded.dictionary.take(pa.array(word)), times, None, None, None, None)

    return run


def _in_bundles(docs: DataFrame, table: DataFrame, run, schema: str) -> DataFrame:
    """``run`` over bundles of documents, each with the codes that occur in it: by shuffle joins, for a table of any size."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    dealt = stored(docs.withColumn("task", F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(1, -(-size // BUNDLE)))).cast("int")))

    def distinct(bundle: pa.Table) -> pa.Table:
        parts = [np.unique(codes(part, where)[0]) for _, _, part, where in K.chunks(*K.text_bytes(bundle.column("text")))]
        found = np.unique(np.concatenate(parts))
        return pa.table({"task": np.full(len(found), bundle.column("task")[0].as_py(), np.int32), "code": found})

    wanted = dealt.groupBy("task").applyInArrow(distinct, "task int, code long")
    given = stored(wanted.join(table, "code"))

    def scored(texts: pa.Table, values: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return pa.table({})
        lookup = Lookup(values.column("code").to_numpy(), values.column("logp").to_numpy())
        found = pa.Table.from_batches(list(run(0, texts.column("doc_id").combine_chunks(), texts.column("text"), lookup)))
        return found.append_column("task", pa.array(np.full(found.num_rows, texts.column("task")[0].as_py(), np.int32)))

    return dealt.groupBy("task").cogroup(given.groupBy("task")).applyInArrow(scored, f"{schema}, task int")


def score(docs: DataFrame, *, folds: int = 5, held: int = 1) -> DataFrame:
    """Score every text: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Learns from rows whose crc32(doc_id as text) mod ``folds`` isn't ``held``. Null text
    counts as empty: one token, the end. Repeated rows each count in training and are
    each scored. A null doc_id is trained on and isn't held out. With no training row
    every estimate is uniform (c, N and V are 0) and base_score is log10(0.5 / 0.5) = 0.
    An empty table gives an empty result. One row per input row.
    """
    spark = docs.sparkSession
    held_out = F.coalesce(crc_mod("doc_id", folds) == held, F.lit(False))
    training = docs.where(~held_out).select("text")
    table = code_table(docs.select("text", (~held_out).alias("learn")))


    def count_words(batches):
        for batch in batches:
            for _, _, part, where in K.chunks(*K.text_bytes(batch.column(0))):
                found = _rows_of_words(K.LOWER[part], where)[1].value_counts()
                if len(found):
                    yield pa.RecordBatch.from_arrays([found.field(0), found.field(1)], names=["word", "n"])

    vocabulary = stored(map_batches(training, count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("c")))
    sizes = vocabulary.groupBy(F.floor(F.log2("c")).cast("int").alias("power")).agg(F.count("*").alias("v"), F.sum("c").alias("n")).orderBy(F.desc("power")).collect()
    n_end = training.count()
    n_all, v_all = n_end + sum(r["n"] for r in sizes), (n_end > 0) + sum(r["v"] for r in sizes)
    room, threshold = TOP_WORDS, None
    for r in sizes:  # at most 64 powers of two
        room -= r["v"]
        if room < 0:
            break
        threshold = 2 ** r["power"]
    frequent = vocabulary.where(F.col("c") >= threshold).toPandas() if threshold else None
    known = pa.array([] if frequent is None else frequent["word"], pa.string())
    c_of = np.append(np.zeros(0, np.int64) if frequent is None else frequent["c"].to_numpy(np.int64), 0)
    top = spark.sparkContext.broadcast((known, c_of))
    below = np.log10(n_all + 0.5 * (v_all + 1))

    # A document is known by the task, or bundle, that read it and its place there.
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind}, word string, n_tokens long, n_known long, base double, score double, bytes long"
    texts = docs.select("doc_id", "text")
    if table.count() <= TOP_CODES:
        pairs = table.toArrow()
        model = spark.sparkContext.broadcast((pairs.column("code").to_numpy(), pairs.column("logp").to_numpy()))
        del pairs

        def run(batches):
            row, lookup, scorer = 0, None, None
            for batch in batches:
                if lookup is None:
                    lookup, scorer = Lookup(*model.value), _scorer(batch.column(0).type, *top.value, n_end, below)
                yield from scorer(row, batch.column(0), batch.column(1), lookup)
                row += len(batch)

        parts = map_batches(texts, run, schema).withColumn("task", F.spark_partition_id())
    else:

        def run(row, doc_ids, column, lookup):
            return _scorer(doc_ids.type, *top.value, n_end, below)(row, doc_ids, column, lookup)

        parts = _in_bundles(texts, table, run, schema)
    parts = stored(parts)
    rare = parts.where("word is not null").select("task", "row", "word", F.col("n_tokens").alias("times"))
    looked_up = rare.join(vocabulary, "word", "left").groupBy("task", "row").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("times"))).alias("more"),
        F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rest"),
    )
    whole = parts.where("word is null").drop("word").join(looked_up, ["task", "row"], "left")
    return whole.select(
        "doc_id", F.coalesce(crc_mod("doc_id", folds) == held, F.lit(False)).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"), "score", (-F.col("score") / np.log10(2) / F.col("bytes")).alias("bits_per_byte"),
    )

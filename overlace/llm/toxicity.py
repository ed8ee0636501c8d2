"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word's vector is the mean of the vectors of its hashed character n-grams, a
document's the mean of its words' vectors, and a linear softmax on top gives the
probability. Embeddings and softmax are trained jointly in numpy with Adam on a
bounded, class-balanced sample of the labelled training rows. As everything above
the embeddings is linear, a trained word adds one number to its document, so scoring
needs each distinct word of a chunk once.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from overlace.llm import kernels as K
from overlace.llm.common import crc_mod, map_batches

#: Bytes that end a word: all of ASCII but letters, digits and the apostrophe.
BREAK = np.array([b < 128 and not (chr(b).isalnum() or b == 39) for b in range(256)])
SIZES = (3, 4, 5)


def distinct_words(data: np.ndarray, at: np.ndarray):
    """The chunk's distinct words (starts, ends) and for each occurrence its row and word."""
    starts, ends, rows = K.words(data, at, BREAK)
    _, first, which = np.unique(K.span_hashes(K.prefix_hashes(data), starts, ends), return_index=True, return_inverse=True)
    return starts[first], ends[first], rows, which


def subwords(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of every n-gram of ``<word>`` and of the word itself, by word."""
    # Lay the words out as <word><word>..., so that n-grams can be read off in place.
    size = ends - starts + 2
    head = np.cumsum(size) - size
    line = np.empty(int(size.sum()), np.uint8)
    line[head], line[head + size - 1] = 60, 62
    line[K.ranges(head + 1, size - 2)] = data[K.ranges(starts, size - 2)]
    total = K.prefix_hashes(line)
    reduced = lambda h: (h % np.uint64(buckets)).astype(np.int32)
    owner, codes = [np.arange(len(starts), dtype=np.int32)], [reduced(K.span_hashes(total, head, head + size))]
    for n in SIZES:
        count = np.maximum(size - n + 1, 0)
        begin = K.ranges(head, count)
        owner.append(np.repeat(np.arange(len(starts), dtype=np.int32), count))
        codes.append(reduced(K.span_hashes(total, begin, begin + n)))
    owner, codes = np.concatenate(owner), np.concatenate(codes)
    order = np.argsort(owner, kind="stable").astype(np.int32)
    return owner[order], codes[order]


UNIT = np.float32(200)  # a mean over words is small


class Bags:
    """Which n-grams make up which words and documents: sums over them and back, an embedding axis at a time."""

    def __init__(self, texts: list[str | None], buckets: int):
        data, at = K.text_bytes(pa.array(texts, pa.large_string()))
        data = K.LOWER[data]
        found = [(np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)]
        for low, _, part, where in K.chunks(data, at, 1 << 20):
            starts, ends, rows = K.words(part, where, BREAK)
            found.append((starts + at[low], ends + at[low], rows + low, K.span_hashes(K.prefix_hashes(part), starts, ends)))
        starts, ends, rows, hashes = (np.concatenate(x) for x in zip(*found, strict=True))
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        self.owner, code = subwords(data, starts[first], ends[first], buckets)
        self.used, code = np.unique(code, return_inverse=True)
        self.code = code.astype(np.int32)
        self.n, self.words = len(texts), len(first)
        pair, count = np.unique(rows * max(self.words, 1) + which, return_counts=True)
        self.doc, self.word = pair // max(self.words, 1), pair % max(self.words, 1)
        self.share = (count / np.maximum(np.bincount(rows, minlength=self.n), 1)[self.doc]).astype(np.float32)
        self.scale = (1 / np.bincount(self.owner, minlength=self.words)).astype(np.float32)
        by_word, by_code = np.argsort(self.word, kind="stable"), np.argsort(self.code, kind="stable")
        heads = lambda x: np.flatnonzero(np.diff(x, prepend=-1))
        self.first_code, self.word_starts, self.code_starts, self.doc_starts = heads(self.owner), heads(self.word[by_word]), heads(self.code[by_code]), heads(self.doc)
        self.owner_by_code, self.doc_by_word, self.share_by_word = self.owner[by_code], self.doc[by_word], self.share[by_word]

    def counts(self, weight: np.ndarray) -> np.ndarray:
        """The sum, over the words that hold an n-gram, of the weights of the documents that hold the word."""
        held = np.bincount(self.word, weights=weight[self.doc], minlength=self.words)
        return np.bincount(self.code, weights=held[self.owner], minlength=len(self.used))

    def pooled(self, embedding: np.ndarray) -> np.ndarray:
        """Each document's mean of its words' means of their n-grams' values, times ``UNIT``."""
        vector = np.add.reduceat(embedding[self.code], self.first_code) * self.scale
        out = np.zeros(self.n, np.float32)
        out[self.doc[self.doc_starts]] = np.add.reduceat(vector[self.word] * self.share, self.doc_starts) * UNIT
        return out

    def pulled(self, error: np.ndarray) -> np.ndarray:
        """The gradient of ``pooled``: each n-gram's share of the documents' errors."""
        to_word = np.add.reduceat(error[self.doc_by_word] * self.share_by_word, self.word_starts) * self.scale * UNIT
        return np.add.reduceat(to_word[self.owner_by_code], self.code_starts)


def loss_and_gradient(theta: dict, bags: Bags, labels: np.ndarray) -> tuple[float, dict]:
    """Class-balanced cross-entropy of the softmax over averaged embeddings, and its gradient in E, W and b."""
    kinds = np.bincount(labels, minlength=2)
    cost, truth = (0.5 / kinds)[labels].astype(np.float32)[:, None], np.eye(2, dtype=np.float32)[labels]
    pooled = np.stack([bags.pooled(axis) for axis in theta["E"]], 1)
    z = pooled @ theta["W"] + theta["b"]
    z = z - z.max(1)[:, None]
    p = np.exp(z) / np.exp(z).sum(1)[:, None]
    error = (p - truth) * cost
    up = error @ theta["W"].T
    loss = float(-(np.log(np.maximum((p * truth).sum(1), 1e-30)) * cost[:, 0]).sum())
    return loss, {"E": np.stack([bags.pulled(axis) for axis in up.T]), "W": pooled.T @ error, "b": error.sum(0)}


def fit(texts: list[str | None], labels: np.ndarray, *, dim: int = 8, buckets: int = 1 << 18, epochs: int = 30, rate: float = 0.05, seed: int = 1) -> dict:
    """Embeddings and softmax trained jointly; returns what each n-gram adds to the log-odds.

    The first embedding axis starts from each n-gram's smoothed log-ratio of training
    documents of either class, cubed, the other axes at random; then full-batch Adam
    trains embeddings, softmax and bias together. An embedding's steps are scaled by
    the evidence for it, so n-grams of a few documents stay near zero.

    Without words, or with one class only, the model is a constant.
    """
    labels = np.asarray(labels, np.int64)
    kinds = np.bincount(labels, minlength=2)
    if not kinds.all():
        return {"weights": np.zeros(buckets, np.float32), "bias": 6.0 if kinds[1] else -6.0, "buckets": buckets}
    bags = Bags(texts, buckets)
    if not bags.words:
        return {"weights": np.zeros(buckets, np.float32), "bias": 0.0, "buckets": buckets}
    seen = [bags.counts((labels == k) / kinds[k]) + 1 / kinds.min() for k in (0, 1)]
    ratio = np.log(seen[1] / seen[0])
    most = max(np.abs(ratio).max(), 1e-6)
    evidence = (np.abs(ratio) / most).astype(np.float32) ** 2
    rng, size = np.random.default_rng(seed), len(bags.used)
    theta = {"E": rng.normal(size=(dim, size)).astype(np.float32) * 1e-3, "W": rng.normal(size=(dim, 2)).astype(np.float32) * 0.1, "b": np.zeros(2, np.float32)}
    theta["E"][0] = ratio**3 / most**3
    theta["W"][0] = -1, 1
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in theta.items()}
    for step in range(1, epochs + 1):
        _, grad = loss_and_gradient(theta, bags, labels)
        for k, g in grad.items():
            first, second = moment[k]
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-10)
            theta[k] -= move * evidence * 0.2 if k == "E" else move * 2
    weights = np.zeros(buckets, np.float32)
    weights[bags.used] = (theta["W"][:, 1] - theta["W"][:, 0]) @ theta["E"] * UNIT
    return {"weights": weights, "bias": float(theta["b"][1] - theta["b"][0]), "buckets": buckets}


def score_texts(column, model: dict) -> np.ndarray:
    """Probability of class 1 for each row of an Arrow text column."""
    data, at = K.text_bytes(column)
    out = np.full(len(at) - 1, model["bias"])
    for low, high, part, where in K.chunks(data, at):
        part = K.LOWER[part]
        starts, ends, rows, which = distinct_words(part, where)
        if not len(starts):
            continue
        owner, code = subwords(part, starts, ends, model["buckets"])
        gain = np.bincount(owner, weights=model["weights"][code], minlength=len(starts)) / np.bincount(owner, minlength=len(starts))
        n = high - low
        out[low:high] += K.row_sums(gain[which], rows, n) / np.maximum(np.bincount(rows, minlength=n), 1)
    return 1 / (1 + np.exp(-np.clip(out, -60, 60)))


def fit_in_task(docs: DataFrame, labels: DataFrame, label: str, fit_, *, folds: int, held: int, max_rows: int, extra: tuple[str, ...] = ()) -> dict:
    """``fit_(texts, labels, *extra)`` of at most ``max_rows`` labelled training rows, half of each class, in hash order.

    Rows whose crc32(doc_id as text) mod ``folds`` is ``held``, and rows with a null in
    the id or the label, are never taken. The fit runs in one Spark task over the bounded
    sample; only the model comes to the driver.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (crc_mod("doc_id", folds) != held)).select("doc_id", F.col(label).cast("int").alias("_label")).distinct()
    picked = None
    for kind in (0, 1):
        part = known.where(F.col("_label") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows // 2)
        picked = part if picked is None else picked.unionByName(part)
    sample = docs.select("doc_id", "text", *extra).join(F.broadcast(picked), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(max_rows).select("_label", "text", *extra)

    def run(batches):
        columns: list[list] = [[] for _ in range(2 + len(extra))]
        for batch in batches:
            for i, values in enumerate(columns):
                values += batch.column(i).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit_(columns[1], np.array(columns[0], np.int64), *columns[2:]))], pa.binary())], names=["model"])

    made = map_batches(sample.coalesce(1), run, "model binary").first()
    return pickle.loads(made["model"]) if made else fit_([], np.zeros(0, np.int64), *([] for _ in extra))


def score(docs: DataFrame, scorer, *, folds: int, held: int) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; ``scorer`` maps an Arrow column to probabilities."""

    def run(batches):
        for batch in batches:
            p = scorer(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, score double, predicted int")
    return scored.select("doc_id", F.coalesce(crc_mod("doc_id", folds) == held, F.lit(False)).alias("held_out"), "score", "predicted")


def train(docs: DataFrame, labels: DataFrame, *, max_rows: int = 2000) -> dict:
    """The toxicity model from at most ``max_rows`` labelled rows outside the held-out fold."""
    return fit_in_task(docs, labels, "toxic", fit, folds=5, held=0, max_rows=max_rows)


def toxicity(docs: DataFrame, labels: DataFrame, *, max_rows: int = 2000) -> DataFrame:
    """Toxicity of every document.

    ``docs``: doc_id, text and any other columns; ``labels``: doc_id, toxic. Returns
    doc_id, held_out, score, predicted, one row per input row.

    Null text counts as empty; an empty text gets the model's bias alone. Repeated rows
    are each scored. Without labels of both classes the score is a constant (near 0,
    or near 1 if all labels are 1). A null doc_id is scored and isn't held out. An empty
    table gives an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, max_rows=max_rows))
    return score(docs, lambda column: score_texts(column, model.value), folds=5, held=0)


def keep_clean(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, that the model doesn't take for toxic.

    Null and empty texts get the model's bias alone; repeated rows, and rows of a null
    doc_id, are each judged. Without labels of both classes all rows stay, or none if all
    labels are 1. Of an empty table nothing stays.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, **options))
    names = docs.columns

    def run(batches):
        for batch in batches:
            clean = score_texts(batch.column(names.index("text")), model.value) < 0.5
            yield batch.filter(pa.array(clean))

    return map_batches(docs, run, docs.schema)

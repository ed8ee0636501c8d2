"""Quality classifier: a factorisation machine.

Features are hashed words (their share of the text), binned structure statistics of the
text and the binned ``n_chars`` metadata. Each feature has a weight and a low-rank
vector; the pairwise interactions of all of them are scored in linear time as
``((sum v x)**2 - sum (v x)**2) / 2``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from overlace.llm import kernels as K
from overlace.llm.common import crc_mod, map_batches
from overlace.llm.toxicity import fit_in_task

WORDS, BINS = 1 << 16, 16
_sets = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "!?", "*$%&#@^~", "|<>{}[]\\=+_", "0123456789", " \t\r", "\n", ".,;:", "\"'()-"]
KINDS = np.zeros(256, np.uint8)
for _i, _s in enumerate(_sets, 1):
    KINDS[[ord(c) for c in _s]] = _i
KINDS[128:] = len(_sets) + 1
#: Shares of the byte kinds, distinct words, repeated neighbours; length, word length, line length; n_chars.
STATS = len(_sets) + 1 + 2 + 3 + 1
FEATURES = WORDS + STATS * BINS


def _binned(share: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(1 + share * 4096).astype(np.int64), BINS - 1)


def features(column, n_chars=None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(row, feature, value) of every row of a text column, by row and feature, and the rows."""
    data, at = K.text_bytes(column)
    given = np.zeros(len(at) - 1)
    if n_chars is not None:
        given = np.nan_to_num(pc.fill_null(n_chars.cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False))
    parts = []
    for low, high, part, where in K.chunks(data, at):
        n, size = high - low, np.maximum(np.diff(where), 1)
        rows_of = np.repeat(np.arange(n, dtype=np.int32), np.diff(where))
        kinds = np.bincount(rows_of * np.int32(16) + KINDS[part], minlength=n * 16).reshape(n, 16)[:, 1 : len(_sets) + 2]
        lower = K.LOWER[part]
        starts, ends, rows = K.words(lower, where, K.SPACE)
        hashes = K.span_hashes(K.prefix_hashes(lower), starts, ends)
        code = (hashes >> np.uint64(48)).astype(np.int64)
        n_words = np.maximum(np.bincount(rows, minlength=n), 1)
        key, count = np.unique(rows * WORDS + code, return_counts=True)
        row, word = key // WORDS, key % WORDS
        same = np.zeros(len(rows))
        same[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
        columns = [_binned(k / size) for k in kinds.T]
        columns.append(_binned(np.bincount(row, minlength=n) / n_words))
        columns.append(_binned(K.row_sums(same, rows, n) / n_words))
        columns.append(np.minimum(np.log2(1 + np.diff(where)).astype(np.int64), BINS - 1))
        columns.append(np.minimum((np.diff(where) / n_words).astype(np.int64) // 2, BINS - 1))
        columns.append(np.minimum(np.log2(1 + size / (kinds[:, 6] + 1)).astype(np.int64), BINS - 1))
        columns.append(np.clip(np.log2(1 + np.maximum(given[low:high], 0)).astype(np.int64), 0, BINS - 1))
        stat = WORDS + np.arange(STATS) * BINS + np.stack(columns, 1)
        all_rows = np.concatenate([row, np.repeat(np.arange(n), STATS)])
        order = np.argsort(all_rows, kind="stable")
        parts.append((all_rows[order] + low, np.concatenate([word, stat.ravel()])[order], np.concatenate([count / n_words[row], np.full(n * STATS, 1.0)])[order]))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), len(at) - 1
    return *(np.concatenate(x) for x in zip(*parts, strict=True)), len(at) - 1


def _margin(model: dict, row, feature, value, n: int):
    """Log-odds of each row, and the rows' sums of v x that the gradient needs."""
    first = np.flatnonzero(np.diff(row, prepend=-1))
    scaled = model["V"][feature] * value[:, None].astype(np.float32)
    sums = np.zeros((n, scaled.shape[1]), np.float32)
    squares = np.zeros((n, scaled.shape[1]), np.float32)
    seen = row[first]
    if len(first):
        sums[seen] = np.add.reduceat(scaled, first)
        squares[seen] = np.add.reduceat(scaled * scaled, first)
    linear = np.bincount(row, weights=model["w"][feature] * value, minlength=n)
    return model["b"] + linear + 0.5 * (sums**2 - squares).sum(1), sums


def fit(texts: list, labels: np.ndarray, n_chars: list | None = None, *, rank: int = 4, epochs: int = 60, rate: float = 0.03, decay: float = 0.002, seed: int = 1) -> dict:
    """Weights and vectors by full-batch Adam with weight decay; a constant where a class is missing."""
    labels = np.asarray(labels, np.int64)
    kinds = np.bincount(labels, minlength=2)
    rng = np.random.default_rng(seed)
    model = {"w": np.zeros(FEATURES, np.float32), "V": (rng.normal(size=(FEATURES, rank)) * 0.02).astype(np.float32), "b": np.float32(0)}
    if not kinds.all():
        return model | {"V": model["V"] * 0, "b": np.float32(6.0 if kinds[1] else -6.0)}
    row, feature, value, n = features(pa.array(texts, pa.large_string()), None if n_chars is None else pa.array(n_chars, pa.float64()))
    # A word of fewer than five sampled texts teaches nothing that carries over.
    common = (feature >= WORDS) | (np.bincount(feature, minlength=FEATURES)[feature] >= 5)
    row, feature, value = row[common], feature[common], value[common]
    cost = (0.5 / kinds)[labels]
    order = np.argsort(feature, kind="stable")
    first = np.flatnonzero(np.diff(feature[order], prepend=-1))
    used = feature[order][first]
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.items()}
    for step in range(1, epochs + 1):
        margin, sums = _margin(model, row, feature, value, n)
        error = ((1 / (1 + np.exp(-np.clip(margin, -60, 60))) - labels) * cost).astype(np.float32)
        pull = (error[row] * value).astype(np.float32)
        g_w = np.zeros(FEATURES, np.float32)
        g_w[used] = np.add.reduceat(pull[order], first)
        g_v = np.zeros_like(model["V"])
        g_v[used] = np.add.reduceat((pull[:, None] * (sums[row] - model["V"][feature] * value[:, None].astype(np.float32)))[order], first)
        for k, g in (("w", g_w), ("V", g_v), ("b", error.sum())):
            m1, m2 = moment[k]
            m1 = 0.9 * m1 + 0.1 * g
            m2 = 0.99 * m2 + 0.01 * g * g
            moment[k] = (m1, m2)
            model[k] = (model[k] * (1 - decay) - rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return model


def score_texts(column, n_chars, model: dict) -> np.ndarray:
    out = np.zeros(len(column))
    data_size = max(1, column.nbytes)
    step = max(1, int(len(column) * K.CHUNK / data_size))
    for low in range(0, len(column), step):
        part = column.slice(low, step)
        margin, _ = _margin(model, *features(part, None if n_chars is None else n_chars.slice(low, step)))
        out[low : low + step] = 1 / (1 + np.exp(-np.clip(margin, -60, 60)))
    return out


def train(docs: DataFrame, labels: DataFrame, *, max_rows: int = 3000) -> dict:
    """The model from at most ``max_rows`` labelled rows outside the held-out fold, half of each class."""
    return fit_in_task(docs, labels, "quality", fit, folds=3, held=1, max_rows=max_rows, extra=("n_chars",) if "n_chars" in docs.columns else ())


def quality(docs: DataFrame, labels: DataFrame, *, max_rows: int = 3000) -> DataFrame:
    """Quality of every document: doc_id, held_out, score, predicted, one row per input row.

    ``docs``: doc_id, text, optionally n_chars, any other columns; ``labels``: doc_id,
    quality. Null text counts as empty, null n_chars as 0; an empty text is scored from
    its statistics. Repeated rows are each scored. Without labels of both classes the
    score is a constant. A null doc_id is scored and isn't held out. An empty table
    gives an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, max_rows=max_rows))
    counted = "n_chars" in docs.columns

    def run(batches):
        for batch in batches:
            p = score_texts(batch.column(1), batch.column(2) if counted else None, model.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = map_batches(docs.select("doc_id", "text", *(["n_chars"] if counted else [])), run, f"doc_id {kind}, score double, predicted int")
    return scored.select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")

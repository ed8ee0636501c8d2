"""Benchmark decontamination by winnowing, with DataFrame functions only.

The hashes of all ``GRAM``-word grams of a text are winnowed: of each ``SPAN``
consecutive hashes the minimum is a fingerprint. Any shared passage of
``WINDOW = GRAM + SPAN - 1`` words holds SPAN grams in a row on both sides, so its
minimum is a fingerprint on both sides: no such passage is missed. Documents and
benchmark items meet on fingerprints; each hit is extended to the windows around it,
which are compared word by word with the items' windows. Items shorter than a window
are one window of their own length: grams of that length, without winnowing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from overlace.llm.common import is_small, met, stored

WINDOW, GRAM = 13, 6
SPAN = WINDOW - GRAM + 1
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body reads it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: str) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def grams(words: Column, size: int) -> Column:
    """Hashes of all grams of ``size`` words, in order."""
    every = F.transform(F.sequence(F.lit(1), F.size(words) - (size - 1)), lambda i: F.xxhash64(F.slice(words, i, size)))
    return F.when(F.size(words) >= size, every).otherwise(F.array().cast("array<bigint>"))


def fingerprints(words: Column, lengths: list[int]) -> Column:
    """The distinct winnowed gram hashes, and all grams of the short items' ``lengths``."""

    def winnow(hashes: Column) -> Column:
        least = F.transform(F.sequence(F.lit(1), F.size(hashes) - (SPAN - 1)), lambda i: F.array_min(F.slice(hashes, i, SPAN)))
        return F.when(F.size(hashes) >= SPAN, F.array_distinct(least)).otherwise(F.array().cast("array<bigint>"))

    found = let(grams(words, GRAM), winnow)
    for n in lengths:
        found = F.array_union(found, grams(words, n))
    return found


def among(hits: Column) -> Column:
    """``hits`` in about sqrt(size) slots by remainder, so that looking one up doesn't scan them all."""
    number = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(hits))).cast("int"))
    return let(number, lambda m: F.transform(F.sequence(F.lit(0), m - 1), lambda slot: F.filter(hits, lambda h: F.pmod(h, m) == slot)))


def windows_at(words: Column, slots: Column, size: int, reach: int) -> Column:
    """(start, size) of the windows that hold a gram of ``size - reach`` words whose hash is in ``slots``."""
    every = lambda hashes: F.when(F.size(hashes) > 0, F.sequence(F.lit(1), F.size(hashes))).otherwise(F.array().cast("array<int>"))
    known = lambda h: F.array_contains(F.get(slots, F.pmod(h, F.size(slots)).cast("int")), h)
    places = let(grams(words, size - reach), lambda hashes: F.filter(every(hashes), lambda i: known(F.get(hashes, i - 1))))
    last = F.size(words) - (size - 1)
    around = F.transform(F.filter(places, lambda p: last >= 1), lambda p: F.sequence(F.greatest(F.lit(1), F.least(p - reach, last)), F.least(p, last)))
    return F.transform(F.array_distinct(F.flatten(around)), lambda s: F.struct(s.alias("start"), F.lit(size).alias("size")))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every document.

    ``docs``: doc_id, text and any other columns; ``benchmark``: item_id, text.

    Null texts, and texts without words, have no words and are never hit; such items are
    never found. A null item_id is left out. Repeated items count once. Rows of one
    doc_id are judged by their own text and all returned, null doc_ids too. Of a
    document without hits the digest is that of the empty string. Empty tables give an
    empty result, or one without hits.
    """
    items = stored(benchmark.where("item_id is not null").select("item_id", words_of("text").alias("words")).where(F.size("words") > 0).distinct())
    lengths = sorted(r[0] for r in items.where(F.size("words") < WINDOW).select(F.size("words")).distinct().collect())  # fewer than WINDOW
    starts = F.when(F.size("words") < WINDOW, F.array(F.lit(1))).otherwise(F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)))
    cut = lambda words, start, size: F.concat_ws(" ", F.slice(words, start, size))
    windows = stored(items.select("item_id", "words", F.explode(starts).alias("start")).select("item_id", cut(F.col("words"), F.col("start"), WINDOW).alias("window")).distinct())
    own = F.when(F.size("words") < WINDOW, F.array(F.xxhash64("words"))).otherwise(fingerprints(F.col("words"), []))
    marks = stored(items.select(F.explode(own).alias("mark")).distinct())

    seen = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    read = stored(
        seen.select(
            "doc_id", "text_hash",
            let(words_of("text"), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), fingerprints(w, lengths).alias("marks"))).alias("w"),
        ).select("doc_id", "text_hash", "w.*")
    )
    hits = stored(met(read.select("doc_id", "text_hash", F.explode("marks").alias("mark")), marks, "mark").groupBy("doc_id", "text_hash").agg(F.collect_set("mark").alias("hits")))
    few = F.broadcast(hits) if is_small(hits) else hits
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])
    # A document's key is its id and text, so repeated rows give their windows once.
    hit = seen.join(few, same(seen, few)).select(seen["doc_id"], seen["text_hash"], words_of("text").alias("words"), among(F.col("hits")).alias("slots"))
    around = windows_at(F.col("words"), F.col("slots"), WINDOW, WINDOW - GRAM)
    for n in lengths:
        around = F.concat(around, windows_at(F.col("words"), F.col("slots"), n, 0))
    spans = hit.select("doc_id", "text_hash", "words", F.explode(around).alias("w")).select("doc_id", "text_hash", "w.start", "w.size", cut(F.col("words"), F.col("w.start"), F.col("w.size")).alias("window"))
    found = stored(met(spans, windows.select("window").distinct(), "window").distinct())

    # Words inside any window: windows in order, each adding what reaches beyond the last end.
    hit_words = F.aggregate(
        F.sort_array(F.collect_list(F.struct("start", "size"))), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, w: F.struct((acc["n"] + F.greatest(F.lit(0), w["start"] + w["size"] - F.greatest(acc["end"], w["start"]))).alias("n"), F.greatest(acc["end"], w["start"] + w["size"]).alias("end")),
        lambda acc: acc["n"].cast("long"),
    )
    counted = found.groupBy("doc_id", "text_hash").agg(hit_words.alias("n_hit"))
    listed = met(found.select("doc_id", "text_hash", "window").distinct(), windows, "window").select("doc_id", "text_hash", "item_id").distinct().groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))

    base = read.select("doc_id", "text_hash", "n_words")
    join = lambda a, b: a.join(b.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"}), a["doc_id"].eqNullSafe(F.col("_id")) & (F.coalesce(a["text_hash"], F.lit(0)) == F.coalesce(F.col("_hash"), F.lit(0))), "left").drop("_id", "_hash")
    out = join(join(base, counted), listed).select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), 13) AS size FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, size, array_to_string(w[s:s + size - 1], ' ') AS window FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM b)),
sizes AS (SELECT DISTINCT size FROM b),
dw AS (SELECT doc_id, size, s, array_to_string(w[s:s + size - 1], ' ') AS window FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes)),
f AS (SELECT doc_id, dw.size, s, item_id FROM dw JOIN bw ON dw.window = bw.window AND dw.size = bw.size),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM f) GROUP BY doc_id),
i AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM f GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN i ON d.doc_id = i.doc_id
"""

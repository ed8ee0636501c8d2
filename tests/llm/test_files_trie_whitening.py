"""Token-id files, the prefix trie and whitening: brute force, round trips, odd rows, empty tables."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from overlace.llm import idfiles, packing, trie, whitening

# 11 token-id files


def ids_of(texts, end=2):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_tokenizer())
    return [[*t.encode(x or "", add_special_tokens=False).ids, end] for x in texts]


def want_of(rows):
    out, start = [], 0
    for (i, _), ids in zip(rows, ids_of([t for _, t in rows]), strict=True):
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("size", [idfiles.FILE, 400])
def test_files_hold_what_the_library_makes(spark, monkeypatch, size):
    monkeypatch.setattr(idfiles, "FILE", size)
    rng = random.Random(3)
    rows = [(i * 7 % 101, " ".join(rng.choice(["Tree", "of", "naïve", "words,", "12", "’s"]) for _ in range(rng.randrange(0, 80)))) for i in range(101)]
    got = idfiles.round_trip(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted(map(tuple, got.collect())) == want_of(sorted(rows))


def test_files_are_read_in_part_and_know_their_dictionary(spark, tmp_path):
    rows = [(i, f"document number {i} says hello " * (i % 5)) for i in range(50)]
    folder = f"file://{tmp_path}/ids"
    idfiles.write_ids(spark.createDataFrame(rows, "doc_id long, text string"), folder)
    got = {r.doc_id: r.ids for r in idfiles.lookup(spark, folder, spark.createDataFrame([(7,), (33,), (99,)], "doc_id long")).collect()}
    want = ids_of([t for _, t in rows])
    assert got == {7: want[7], 33: want[33]}
    index = idfiles.read_index(spark, folder).collect()
    dictionary = (tmp_path / "ids" / "dictionary").read_bytes()
    assert {r.dictionary for r in index} == {hashlib.sha256(dictionary).hexdigest()}
    for r in index:
        raw = (tmp_path / "ids" / r.file).read_bytes()
        assert raw[: idfiles.HEADER] == idfiles.MAGIC + bytes.fromhex(r.dictionary) and r.offset + r.size <= len(raw)
    (tmp_path / "ids" / "dictionary").write_bytes(dictionary + b"x")
    with pytest.raises(Exception, match="dictionary"):
        idfiles.read_ids(idfiles.read_index(spark, folder), folder).collect()


def test_files_of_odd_and_empty(spark, odd):
    got = idfiles.round_trip(odd).orderBy("start").collect()
    assert len(got) == odd.count() and [r.doc_id for r in got] == [None, None, 1, 2, 3, 4, 5, 5, 6, 7, 8, 9]
    held = {r.doc_id: r.n_tokens for r in got if r.doc_id}
    assert held[1] == held[2] == held[3] == 1 and held[4] > 60_000
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:i]) for i in range(len(got))]
    assert idfiles.round_trip(odd.limit(0)).count() == 0


# 12 prefix trie


def brute_trie(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            convs[c].append(((t is not None, t or 0), hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).hexdigest(), r, x))
    convs = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in convs.items()}
    seqs = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        seqs[c] = tuple(convs.get(c - c % 100, [])[:h] + own[h:])
    members, kids, leaves, saved, ends = (defaultdict(list) for _ in range(5))
    for c, s in seqs.items():
        ends[s].append(c)
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]].append((len(m) - 1) * len(p[-1][1]) if p else 0)
            leaves[p[:d]].append(not kids[p])
    sha = lambda p: hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()
    return [(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), sum(leaves[p]), sum(saved[p]), sha(p)) for p, m in members.items()]


CONVS = "conv_id long, turn long, role string, text string, key string, depth string, place string"


def made(spark, rows):
    return spark.createDataFrame([(*r, "k", "d", "p") for r in rows], CONVS)


@pytest.mark.parametrize(("seed", "chunk"), [(1, 1 << 16), (2, 5), (3, 40)])
def test_trie_equals_brute_force(spark, monkeypatch, seed, chunk):
    monkeypatch.setattr(trie, "CHUNK", chunk)
    rng = random.Random(seed)
    rows = []
    for c in [0, *rng.sample(range(1, 330), 130)]:
        for t in range(rng.choice([0, 1, 2, 3, 3, 5, 8, 30])):
            rows.append((c, t if rng.random() < 0.9 else None, rng.choice(["user", "bot", None, ""]), rng.choice(["a", "bb", "ccc é😀", None, ""])))
    rows += [(None, 1, "user", "x"), rows[0], rows[0]] + [(100, 1, "user", "only")] * 3
    got = trie.prefix_trie(trie.rebuilt(made(spark, rows)))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute_trie(rows)))


def test_trie_of_a_long_conversation_and_many_copies(spark):
    rows = [(0, t, "u", f"turn {t}") for t in range(900)] + [(c, t, "u", f"turn {t}") for c in range(100, 500) for t in range(7)]
    got = trie.prefix_trie(trie.rebuilt(made(spark, rows)))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute_trie(rows)))


def test_trie_of_empty_tables(spark):
    assert trie.prefix_trie(trie.rebuilt(made(spark, []).limit(0))).count() == 0
    assert trie.prefix_trie(trie.rebuilt(made(spark, [(None, 1, "u", "x")]))).count() == 0


# 13 whitening


def plain_whitening(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    v = (x - s / n).T @ (x - s / n) / n
    e, q = np.linalg.eigh(v)
    order = np.argsort(-e)[:k]
    return [sum(int(n * a - b) ** 2 for a, b in zip(r, s, strict=True)) for r in x], (x - s / n) @ q[:, order] / np.sqrt(e[order]), e[order] / e.sum()


SCHEMA = "vec_id long, embedding array<float>, row string, off string, x string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "r", "o", "x") for i, v in rows], SCHEMA)


@pytest.mark.parametrize(("n", "dim", "rows_a_block", "cols"), [(40, 5, 1024, 1024), (700, 12, 16, 5), (300, 9, 7, 4)])
def test_whitening_equals_numpy(spark, monkeypatch, n, dim, rows_a_block, cols):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", rows_a_block)
    monkeypatch.setattr(whitening, "BLOCK_COLS", cols)
    rng = np.random.default_rng(n)
    data = (rng.normal(size=(n, dim)) @ np.diag(np.arange(1, dim + 1)) @ rng.normal(size=(dim, dim)) + 50).astype(np.float32)
    got = whitening.whiten(vectors(spark, [(i, v.tolist()) for i, v in enumerate(data)]).repartition(7)).collect()
    deviation, y, explained = plain_whitening(data)
    assert len(got) == n * min(8, dim)
    sign = {}
    for r in got:
        want = y[r.vec_id, r.component - 1]
        sign.setdefault(r.component, np.sign(want * r.whitened))
        assert r.n == n and r.deviation == deviation[r.vec_id] and abs(sign[r.component] * r.whitened - want) < 1e-8
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9


def test_whitening_of_odd_and_empty(spark):
    rng = np.random.default_rng(5)
    good = [(i if i else None, v.tolist()) for i, v in enumerate(rng.normal(size=(30, 3)))]
    bad = [(50, None), (51, [1.0, None, 2.0]), (52, [float("nan"), 1.0, 1.0]), (53, [float("inf"), 1.0, 1.0]), (54, []), (55, [1.0, 2.0]), (56, [3e38, 0.0, 0.0])]
    got = whitening.whiten(vectors(spark, good + good[3:5] + bad))
    assert got.count() == 32 * 3 and {r.vec_id for r in got.select("vec_id").distinct().collect()} == {i for i, _ in good} and got.first().n == 32
    assert whitening.whiten(vectors(spark, bad)).where("vec_id = 55").count() in (0, 3)
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, None)]):
        assert whitening.whiten(vectors(spark, rows)).count() == 0
    flat = whitening.whiten(vectors(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(10)]))
    assert {r.component for r in flat.collect()} == {1} and abs(flat.agg(F.max("explained")).first()[0] - 1) < 1e-9


# Hashes of spans


def thue_morse(k):
    word = "a"
    for _ in range(k):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_thue_morse_words_aren_t_taken_for_equal(spark, monkeypatch):
    from overlace.llm import kernels, neardup

    one, two = thue_morse(10)
    data = np.frombuffer((one + two).encode(), np.uint8)
    spans = np.array([0, 1024]), np.array([1024, 2048])
    weak, strong = kernels.span_hashes(kernels.prefix_hashes(data), *spans), kernels.strong_hashes(data, *spans)
    assert weak[0] == weak[1] and strong[0] != strong[1]
    docs = spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(docs).collect()} == {1: 1, 2: 2, 3: 1}
    for hashes in (kernels.strong_hashes, lambda data, starts, ends: np.zeros(len(starts), np.uint64)):  # and where all hashes agree
        monkeypatch.setattr(kernels, "strong_hashes", hashes)
        words = packing.Parts(packing.default_tokenizer())
        got = {low + i: ids[at[i] : at[i + 1]].tolist() for texts in ([one], [two, f"{two} {one}"]) for low, ids, at in words.encode(packing.pa.array(texts)) for i in range(len(at) - 1)}
        assert got == dict(enumerate(ids_of([two, f"{two} {one}"], end=1)))


def test_many_rounds_keep_sequences_apart(spark, monkeypatch):
    """Every round of the exchange gets numbers of its own, however many there were."""
    made = packing._pack_group
    monkeypatch.setattr(packing, "_pack_group", lambda capacity, round_: made(capacity, round_ + 300))
    rng = np.random.default_rng(8)
    items = packing.stored(spark.createDataFrame([(i, int(n)) for i, n in enumerate(rng.integers(1, 3000, 200))], "id int, length long"))
    got = packing.pack_pieces(items, group=8).collect()
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.offset + r.length))
    assert len(got) == 200 and all(s[0][0] == 0 and s[-1][1] <= 4096 and all(b[0] == a[1] for a, b in zip(s, s[1:])) for s in map(sorted, held.values()))

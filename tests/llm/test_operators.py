"""Every operator on odd rows and empty tables, and against brute force on small ones."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import table
from pyspark.sql import functions as F

from overlace.llm import decontaminate, exactdup, kernels, lines, lm, neardup, packing, pii, quality, queries, toxicity, urls

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string"


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOW))


def as_dict(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def invented(rng, n, size=(1, 60)):
    return [" ".join("".join(rng.choice(["ta", "ren", "o", "li", "sk"]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(*size))) for _ in range(n)]


# Kernels


def test_words_and_hashes_equal_a_plain_split():
    texts = ["A b  c", None, "", "\n x\ty ", "é è\x0bz", "one"]
    data, at = kernels.text_bytes(pa.array(texts))
    starts, ends, rows = kernels.words(kernels.LOWER[data], at, kernels.SPACE)
    got = [bytes(kernels.LOWER[data][s:e]).decode() for s, e in zip(starts, ends, strict=True)]
    assert [(int(r), w) for r, w in zip(rows, got, strict=True)] == [(i, w) for i, t in enumerate(texts) for w in words(t)]
    h = kernels.span_hashes(kernels.prefix_hashes(kernels.LOWER[data]), starts, ends)
    assert len(set(h.tolist())) == len(set(got))


# 1 decontamination


def brute_contamination(docs, items):
    pattern = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
    cut = lambda t: re.findall(pattern, (t or "").translate(LOW))
    wins = {}
    for i, t in items:
        w = cut(t)
        size = min(13, len(w))
        for s in range(len(w) - size + 1) if w else ():
            wins.setdefault((size, tuple(w[s : s + size])), set()).add(str(i))
    out = []
    for d, t in docs:
        w = cut(t)
        hit, found = set(), set()
        for size in range(1, 14):
            for s in range(len(w) - size + 1):
                if (size, tuple(w[s : s + size])) in wins:
                    hit |= set(range(s, s + size))
                    found |= wins[size, tuple(w[s : s + size])]
        out.append((d, len(w), len(hit), len(found), ",".join(sorted(found)), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def test_contamination_equals_brute_force(spark):
    import hashlib

    rng = random.Random(1)
    items = [(i, t) for i, t in enumerate(invented(rng, 12, (13, 40)))] + [(90, "ta-ren"), (91, "o li sk ta ren"), (91, "o li sk ta ren"), (92, ""), (93, None)]
    docs = []
    for d, t in enumerate(invented(rng, 40, (0, 120))):
        if d % 2:
            source = items[d % 12][1].split()
            at = rng.randrange(max(1, len(source) - 14))
            t = f"{t} {' '.join(source[at : at + rng.randrange(11, 16)]).upper()}. {t}"
        docs.append((d, t))
    docs += [(100, None), (101, ""), (102, "--"), (3, docs[3][1]), (None, items[0][1])]
    got = decontaminate.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"))
    want = [(d, n, h, i, hashlib.sha256(s.encode()).hexdigest(), c) for d, n, h, i, s, c in brute_contamination(docs, items)]
    assert table([tuple(r) for r in got.collect()], got.columns) == table(want, ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def test_contamination_of_odd_and_empty(spark, odd):
    bench = spark.createDataFrame([(1, "the lazy dog near the quiet river bank at dawn")], "item_id long, text string")
    got = decontaminate.contamination(odd, bench)
    assert got.count() == odd.count() and {r.doc_id for r in got.where("n_hit > 0").collect()} == {5, 6, 7, None}
    assert decontaminate.contamination(odd.limit(0), bench).count() == 0
    assert decontaminate.contamination(odd, bench.limit(0)).where("contaminated").count() == 0


# 2 lines


@pytest.mark.parametrize("size", [5, 8])
def test_lines_equal_brute_force(spark, size):
    rng = random.Random(2)
    base = [t for t in invented(rng, 12, (6, 12))]
    docs = [(d, "\n".join(b if rng.random() < 0.5 else b[: rng.randrange(5, len(b))] + "x" for b in rng.sample(base, 5)) + rng.choice(["", "\n", "\n \n"])) for d in range(20)] + [(50, None), (51, "")]
    flat = [(d, i, s.translate(LOW).strip("\x20\x09\x0a\x0b\x0c\x0d")) for d, t in docs for i, s in enumerate((t or "").split("\n"))]
    sets = [frozenset(s[j : j + size] for j in range(max(1, len(s) - size + 1))) if s else frozenset() for _, _, s in flat]
    parent = list(range(len(flat)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    kept = {(d, i) for k, (d, i, s) in enumerate(flat) if not s or find(k) == k}
    got = {(r.doc_id, r.line): r.kept for r in lines.fuzzy_lines(spark.createDataFrame(docs, DOCS), shingle=size).collect()}
    assert got == {(d, i): (d, i) in kept for d, i, _ in flat}


def test_lines_of_odd_and_empty(spark, odd):
    got = as_dict(lines.line_report(odd.where("doc_id is not null")))
    assert got[1]["n_lines"] == 1 and got[1]["n_dropped"] == 0 and got[3]["n_lines"] == 2 and got[6]["n_dropped"] == 1 and got[9]["dropped"] == [0]
    assert lines.line_report(odd.limit(0)).count() == 0


def test_wanted_lines_are_read_without_moving_documents(spark, monkeypatch):
    docs = spark.range(300).selectExpr("id as doc_id", "concat_ws('\n', transform(sequence(0, 9), i -> concat('line ', i, ' of ', id))) as text")
    wanted = [(d, d % 10, lines.digests([f"line {d % 10} of {d}".encode()])[0]) for d in range(0, 300, 20)]
    frame = spark.createDataFrame(wanted, "doc_id long, line int, node binary")
    texts = lines._texts(docs, frame)
    got = {bytes(r.node): bytes(r.items) for r in texts.collect()}
    assert {n: f"line {k} of {d}".encode() for d, k, n in wanted}.items() <= got.items() and len(got) < 1000
    assert "Join" not in texts._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(lines, "MARKS", 64)  # a full map loses none
    assert {n for _, _, n in wanted} <= {bytes(r.node) for r in lines._texts(docs, frame).collect()}


def test_one_typo_in_a_short_line_is_fuzzy(spark, tmp_path):
    line = "Subscribe to our newsletter for weekly updates and news"
    other = "читайте также другие новости нашего сайта на сегодня и завтра"
    docs = [(1, f"{line}\nfirst page"), (2, line.replace("letter", "lettex")), (3, other), (4, other.replace("сайта", "сайтx")), (5, "an entirely different line about rivers and boats")]
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = as_dict(queries.op2_fuzzy_lines(spark, str(tmp_path)))
    assert {d: r["dropped"] for d, r in got.items()} == {1: [], 2: [0], 3: [], 4: [0], 5: []}
    assert (1 - 0.8**lines.ROWS) ** lines.BANDS < 2e-3


def test_recall_of_bands_on_random_sets():
    """Pairs of similarity 0.8 share a bucket, in small sets, whose bins are mostly empty, as in large ones."""
    rng = np.random.default_rng(4)
    for shared, own in ((8, 1), (24, 3), (80, 10), (400, 50)):
        pairs = [rng.integers(0, 1 << 63, shared + 2 * own, dtype=np.uint64) for _ in range(400)]
        sets = [kernels.mix(x) for p in pairs for x in (p[: shared + own], np.concatenate([p[:shared], p[shared + own :]]))]
        keys = lines.band_keys(np.concatenate(sets), np.arange(len(sets) + 1) * (shared + own))
        assert (keys[::2] == keys[1::2]).any(1).mean() >= 0.99
        assert not (keys[:-2:2] == keys[2::2]).any()


def test_shingles_equal_sets_of_substrings():
    texts = ["abcdefg", "abcde", "abcd", "a", "aaaaaaaaaa", "читайте сайта", "漢字かな交じり文", "😀😀b", "abcdefg x", "bcdefg"]
    for size in (1, 3, 5, 8):
        made, at = lines.line_sets([t.encode() for t in texts], size)
        plain = [{t[i : i + size] for i in range(max(1, len(t) - size + 1))} for t in texts]
        got = [set(made[i:j].tolist()) for i, j in zip(at, at[1:])]
        assert [len(x) for x in got] == [len(x) for x in plain]
        assert all(len(a & b) == len(x & y) for a, x in zip(got, plain, strict=True) for b, y in zip(got, plain, strict=True))


def test_entries_name_every_line_of_a_shared_bucket():
    rng = np.random.default_rng(5)
    tasks = [(rng.permutation(60)[:25].astype(np.uint64) + np.uint64(1)) for _ in range(4)]
    bucket_of = lambda keys: kernels.mix(np.stack([keys * np.uint64(0) + keys % np.uint64(7 + b) + np.uint64(100 * b) for b in range(lines.BANDS)], 1))
    batches = [lines._entries(k, bucket_of(k), 3) for k in tasks]
    got = set()
    for part in range(3):
        met = lines._meet(pa.Table.from_batches([b.slice(part, 1) for b in batches]))
        got |= set(zip(met["bucket"].to_pylist(), met["key"].to_pylist(), strict=True))
    members = {}
    keys = np.unique(np.concatenate(tasks))
    for k, row in zip(keys.tolist(), bucket_of(keys).tolist(), strict=True):
        for b in row:
            members.setdefault(b, set()).add(k)
    named = {}
    for b, k in got:
        named.setdefault(b, set()).add(k)
    assert sorted(map(sorted, named.values())) == sorted(sorted(m) for m in members.values() if len(m) > 1)


# 3 language model


def brute_ctw(train, test):
    counts, kids = {}, {}
    past = lambda b, i: tuple(([lm.END] * lm.DEPTH + b[:i])[::-1][: lm.DEPTH])
    steps = lambda t: [(past(b, i), 1 << k | x >> (8 - k), x >> (7 - k) & 1) for b in [[*t.translate(LOW).encode(), 255]] for i, x in enumerate(b) for k in range(8)]
    for t in train:
        for c, node, bit in steps(t):
            for d in range(lm.DEPTH + 1):
                counts.setdefault((node, c[:d]), [0, 0])[bit] += 1
                if d:
                    kids.setdefault((node, c[: d - 1]), set()).add(c[:d])
    kt = lambda z, o: math.lgamma(z + 0.5) + math.lgamma(o + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(z + o + 1)

    def weighted(n, c):
        own = kt(*counts[n, c])
        return own if len(c) == lm.DEPTH else np.logaddexp(own, sum(weighted(n, x) for x in kids.get((n, c), ()))) - math.log(2)

    def one(n, d, c):
        z, o = counts.get((n, c[:d]), (0, 0))
        p = (o + 0.5) / (z + o + 1)
        if d == lm.DEPTH or (n, c[:d]) not in counts:
            return p
        share = 1 / (1 + math.exp(kt(z, o) - sum(weighted(n, x) for x in kids[n, c[:d]])))
        return (1 - share) * p + share * one(n, d + 1, c)

    return [sum(math.log10(p if bit else 1 - p) for c, n, bit in steps(t) for p in [one(n, 0, c)]) for t in test]


def test_scores_equal_brute_force(spark):
    docs = [(i, t) for i, t in enumerate(["Abra cadabra", "", "hello Hello  hello", "ñandú 12\nabra", "x", None, "hello abra", "cadabra ñandú", "zz zz y", "abra"])]
    got = as_dict(lm.score(spark.createDataFrame(docs, DOCS)))
    out = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in docs}
    train = Counter(w for i, t in docs if not out[i] for w in [*words(t), None])
    n, v = sum(train.values()), len(train)
    model = brute_ctw([t or "" for i, t in docs if not out[i]], [t or "" for _, t in docs])
    for (i, t), s in zip(docs, model, strict=True):
        tokens = [*words(t), None]
        base = sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out[i], len(tokens), sum(train[w] > 0 for w in tokens), n)
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(s, rel=1e-4)


def test_bundles_score_as_the_broadcast_does(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*invented(random.Random(3), 60), None, ""])], DOCS)
    whole = as_dict(lm.score(docs))
    monkeypatch.setattr(lm, "TOP_CODES", 1)
    monkeypatch.setattr(lm, "BUNDLE", 2000)
    monkeypatch.setattr(lm, "TOP_WORDS", 4)
    few = as_dict(lm.score(docs))
    assert few.keys() == whole.keys()
    for i, r in whole.items():
        assert all(few[i][k] == (pytest.approx(v) if isinstance(v, float) else v) for k, v in r.items())


def test_code_probabilities_of_a_context_sum_to_one():
    train = "the cat sat on the mat that the cat had".encode()
    data = np.frombuffer(train * 3, np.uint8)
    seen = np.unique(lm.codes(data, np.array([0, len(data)]))[0])
    context = seen[len(seen) // 2] >> 8
    code, n = lm._merged(np.concatenate([seen, (context << 8) + np.arange(256)]), np.concatenate([np.full(len(seen), 3), np.zeros(256, np.int64)]))
    groups = [code[(code >> 8 & 0xFFFF) == e] for e in np.unique(code >> 8 & 0xFFFF)]
    sums = [lm.sums_of_two(pa.table({"code": g, "n": n[np.isin(code, g)]})).to_pandas() for g in groups]
    import pandas as pd

    top = pd.concat(sums).groupby(["context", "decision"], as_index=False).sum()
    made, rest = lm.upper(*(top[c].to_numpy() for c in ("context", "decision", "zeros", "ones", "weighted")))
    of = {int(c): p for g in groups for c, p in zip(g, lm.log_probabilities(g, n[np.isin(code, g)], made, rest), strict=True)}
    assert sum(10 ** of[int((context << 8) + b)] for b in range(256)) == pytest.approx(1)


@pytest.mark.parametrize("most", [1, 40])
def test_split_endings_give_the_scores_of_whole_ones(spark, monkeypatch, most):
    rng = random.Random(most)
    docs = spark.createDataFrame([(i, "".join(rng.choice("aab ") for _ in range(rng.randrange(90))) + "é" * (i % 3)) for i in range(60)] + [(99, None), (100, "")], DOCS)
    whole = as_dict(lm.score(docs))
    monkeypatch.setattr(lm, "SPLIT", most)
    parts = as_dict(lm.score(docs))
    assert all(parts[i]["score"] == pytest.approx(whole[i]["score"], rel=1e-6) for i in whole)
    counted = spark.createDataFrame([(rng.randrange(1 << 24) << 24 | rng.randrange(2) << 8 | rng.randrange(256), 1) for _ in range(2000)], "code long, n long").distinct()
    rows, split = lm.with_endings(counted)
    sizes = rows.groupBy("depth", "ending").count().collect()
    assert split and sum(r["count"] for r in sizes) == counted.count()
    assert all(r["count"] <= most or r.depth == lm.DEPTH for r in sizes) and {r.depth for r in sizes} - {2}


def test_rare_words_are_joined(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"common common word{i % 7}") for i in range(40)], DOCS)
    whole = as_dict(lm.score(docs))
    monkeypatch.setattr(lm, "TOP_WORDS", 1)
    few = as_dict(lm.score(docs))
    assert all(few[i]["n_known"] == whole[i]["n_known"] and few[i]["base_score"] == pytest.approx(whole[i]["base_score"]) for i in whole)


def test_scores_of_odd_and_empty(spark, odd):
    got = lm.score(odd)
    assert got.count() == odd.count() and {r.n_tokens for r in got.where("doc_id in (1, 2, 3)").collect()} == {1}
    assert lm.score(odd.limit(0)).count() == 0


# 4 urls


def test_urls(spark):
    cases = [
        ("https://a.example.net/en/1", "a.example.net", "/en/1", "example.net/en/", "allow"), ("HTTP://EXAMPLE.NET/de?x", "example.net", "/de", "net/", "block"), ("https://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
        ("https://example.com/de/x#y", "example.com", "/de/x", "example.com/de/", "block"), ("x://b.org/fr/?q", "b.org", "/fr/", "org/fr/", "allow"), ("https://x.net", "x.net", "", None, "allow"), ("https://x.net?a/b", "x.net", "", None, "allow"),
        ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("https://www.cheap-pills.example.org/en/", "www.cheap-pills.example.org", "/en/", None, "block"), ("https://cheap-pillsx.example.org/", "cheap-pillsx.example.org", "/", None, "allow"),
        ("https://spam-farm.org/fr/1", "spam-farm.org", "/fr/1", "org/fr/", "allow"),
    ]
    df = spark.createDataFrame([(i, c[0], "t", "r") for i, c in enumerate([*cases, cases[0]])], "page_id long, url string, token string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.filter_urls(df).collect()}
    assert got == {i: c[1:] for i, c in enumerate([*cases, cases[0]])}
    assert urls.filter_urls(df.limit(0)).count() == 0
    anywhere = urls.filter_urls(df, rules=(urls.Rule("all", "q|x", "block", ()),))
    assert anywhere.where("verdict = 'block'").count() > 3


def test_index_finds_what_a_scan_of_all_rules_finds(spark, duck, tmp_path):
    rng = random.Random(4)
    labels = [x + j + y for x, y in urls.LABELS for j in ("-", "", ".", "--")] + ["www", "Example", "net", "org", "com", "de", "x1"]
    made = []
    for i in range(600):
        host = ".".join(rng.choice(labels) for _ in range(rng.randrange(1, 5)))
        host = host.upper() if rng.random() < 0.2 else host
        made.append((i, rng.choice(["http://", "https://", ""]) + host + rng.choice(["", "/", "/en/", "/de/x", "/fr/", "/EN/", "/spam-farm.x", "?q=spam-farm.", "#a/fr/"])))
    made += [(600 + i, u) for i, u in enumerate(["http://spamfarm.com/x", "http://www.adultcam.io/", "http://spam-farm.com", "http://notspamfarm.com/", None, "", "://", "http://"])]
    df = spark.createDataFrame(made, "page_id long, url string")
    rules = urls.HOST_RULES + urls.PATTERN_RULES
    df.write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: (r.rule, r.verdict) for r in urls.filter_urls(spark.read.parquet(f"{tmp_path}/pages.parquet")).collect()}
    for i, url in made:
        rest = (url or "").partition("://")[2]
        host = re.match("[^/?#]*", rest)[0]
        target = host.translate(LOW) + re.match("[^?#]*", rest[len(host) :])[0]
        hits = sorted((r for r in rules if re.search(r.pattern, target)), key=lambda r: (-r.rank, -len(r.name), r.name))
        want = (hits[0].name if hits[0].rank else None, hits[0].verdict) if hits else (None, "allow")
        assert got[i] == want, url
    assert got[600][1] == got[601][1] == got[602][1] == "block" and got[603][1] == "allow"
    sql = urls.SQL.replace("FROM pages", f"FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert {p: (r, v) for p, _, _, r, v in duck.execute(sql).fetchall()} == got


# 5 pseudonyms


def test_permutations_and_formats():
    for size in (1, 2, 3, 10, 97, 256, 1000):
        assert sorted(pii.permute(i, size, b"k", "t") for i in range(size)) == list(range(size))
    luhn = lambda d: pii.luhn_digit(d[:-1]) == d[-1]
    text, n = pii.pseudonymise("card 4539578763621486, 4539-5787-6362-1486; 4539578763621487 mail a.b@x.org 10.0.0.256 10.0.0.25 2024-02-29 2023-02-29 DE89370400440532013000", b"k")
    cards = re.findall(r"\b\d{16}\b", text)
    assert n == 6 and luhn(cards[0]) and cards[0] != "4539578763621486" and cards[1] == "4539578763621487"
    assert re.search(r"(\d{4}-){3}\d{4}", text)[0].replace("-", "") == cards[0]
    assert "10.0.0.256" in text and "10.0.0.25 " not in text and "2023-02-29" in text and "2024-02-29" not in text and "a.b@x.org" not in text


def test_pseudonyms_link_documents(spark, odd):
    df = spark.createDataFrame([(1, "call +1 (555) 123-4567"), (2, "or +1 (555) 123-4567!"), (3, None), (4, ""), (None, "plain")], DOCS)
    got = as_dict(pii.pseudonyms(df, key="k"))
    number = lambda t: re.search(r"\+.*\d", t)[0]
    assert number(got[1]["text"]) == number(got[2]["text"]) != "+1 (555) 123-4567"
    assert got[3]["text"] is None and got[4]["text"] == "" and got[None]["text"] == "plain" and got[1]["n_replaced"] == 1
    assert pii.pseudonyms(odd, key="k").count() == odd.count() and pii.pseudonyms(odd.limit(0), key="k").count() == 0


def test_numbers_beside_numbers_get_pseudonyms():
    card, account = "4111 1111 1111 1111", "ES9121000418450200051332"
    for text, value in (
        (f"{card} 12/27", card), ("4111111111111111 123", "4111111111111111"), ("no 7 4111111111111111", "4111111111111111"), (f"{card} 2024-05-06", card), (f"9 8 7 6 {card} 5", card),
        (f"{account} 2024", account), (f"{account} BIC", account), ("ES91 2100 0418 4502 0005 1332 BIC", "ES91 2100 0418 4502 0005 1332"), (f"AB12 CDEF GHIJ {account}", account), ("GB82WEST12345698765432 2024 BIC", "GB82WEST12345698765432"),
    ):
        made, n = pii.pseudonymise(text, b"k")
        at = text.index(value)
        assert n >= 1 and len(made) == len(text) and made[:at] == text[:at] and value not in made, text
        fresh = made[at : at + len(value)]
        again = pii._card if value[0] == "4" else pii._iban
        assert fresh == again(value, b"k") and again(fresh, b"k") is not None
    assert pii.pseudonymise("4111 1111 1111 1112", b"k")[1] == 0



def plain_permutation(value, size, key, tweak):
    """The keyed permutation said again: eight rounds, over and over until the value is in range."""
    import hashlib
    import hmac

    if size < 2:
        return value
    bits = max(2, len(bin(size - 1)) - 2)
    small, large = bits // 2, bits - bits // 2
    while True:
        halves, widths = [value // 2**small, value % 2**small], [large, small]
        for r in range(8):
            seal = int(hmac.new(key, f"{tweak}|{size}|{r}|{halves[1]}".encode(), hashlib.sha256).hexdigest(), 16)
            halves, widths = [halves[1], halves[0] ^ seal % 2 ** widths[0]], widths[::-1]
        value = halves[0] * 2**small + halves[1]
        if value < size:
            return value


def plain_pseudonym(kind, text, key):
    """A value's pseudonym, kind by kind, said again."""
    import datetime

    def run(s, letters, tweak):
        n = plain_permutation(sum(letters.index(c) * len(letters) ** k for k, c in enumerate(reversed(s))), len(letters) ** len(s), key, f"{tweak}{len(s)}")
        return "".join(letters[n // len(letters) ** k % len(letters)] for k in reversed(range(len(s))))

    def shaped(s, new):
        out, k = "", 0
        for c in s:
            out, k = (out + new[k], k + 1) if c.isdigit() else (out + c, k)
        return out

    digits = "".join(c for c in text if c.isdigit())
    if kind == "card":
        body = run(digits[:-1], "0123456789", "card")
        check = next(c for c in "0123456789" if sum(int(d) if k % 2 == 0 else sum(map(int, str(2 * int(d)))) for k, d in enumerate(reversed(body + c))) % 10 == 0)
        return shaped(text, body + check)
    if kind == "phone":
        code, rest = text.split(" ", 1) if text[0] == "+" else ("", text)
        made = shaped(rest, run("".join(c for c in rest if c.isdigit()), "0123456789", f"phone{code}"))
        return f"{code} {made}" if code else made
    if kind == "ip":
        n = plain_permutation(sum(int(p) << 8 * (3 - i) for i, p in enumerate(text.split("."))), 2**32, key, "ip")
        return f"{n >> 24}.{n >> 16 & 255}.{n >> 8 & 255}.{n & 255}"
    if kind == "date":
        first = datetime.date(1900, 1, 1)
        size = (datetime.date(2100, 1, 1) - first).days
        day = datetime.date.fromisoformat(text if text[4] in "-" else text.replace("/", "-") if text[4] == "/" else "-".join(reversed(text.split("."))))
        made = (first + datetime.timedelta(plain_permutation((day - first).days, size, key, "date"))).isoformat()
        return made if text[4] == "-" else made.replace("-", "/") if text[4] == "/" else ".".join(reversed(made.split("-")))
    if kind == "email":
        parts = re.split("([0-9]+|[A-Za-z]+)", text[: text.rindex(".")])
        new = [p if not p or not p[0].isalnum() else run(p, "0123456789", "email") if p.isdigit() else run(p.lower(), "abcdefghijklmnopqrstuvwxyz", "email") for p in parts]
        return "".join(n.upper() if c.isupper() else n for c, n in zip("".join(parts), "".join(new), strict=True)) + text[text.rindex(".") :]
    return text


def test_pseudonyms_equal_a_plain_restatement(spark):
    rng = random.Random(5)
    values = [("card", "4539 5787 6362 1486"), ("card", "4539578763621486"), ("card", "378282246310005"), ("phone", "+1 (555) 123-4567"), ("phone", "+44 (20) 123 4567"), ("phone", "(555) 123-4567"), ("ip", "10.0.0.25"), ("ip", "255.1.2.3"),
              ("date", "2024-02-29"), ("date", "2024/02/29"), ("date", "29.02.2024"), ("date", "1999-12-31"), ("email", "a.b@x.org"), ("email", "A.B@x.org"), ("email", "jane_doe99@mail.example.com")]
    left = [("", v) for v in ("4539578763621487", "10.0.0.256", "2023-02-29", "31.02.2024", "x@y", "plain", "v1.2.3", "2024")]
    docs, want = [], {}
    for i in range(120):
        picked = [rng.choice(values + left) for _ in range(rng.randrange(0, 8))]
        docs.append((i, "".join(f"word {v}; " for _, v in picked)))
        want[i] = ("".join(f"word {plain_pseudonym(k, v, b'k')}; " for k, v in picked), sum(k != "" for k, _ in picked))
    assert {r.doc_id: (r.text, r.n_replaced) for r in pii.pseudonyms(spark.createDataFrame(docs, DOCS), key="k").collect()} == want
    made = {v: plain_pseudonym(k, v, b"k") for k, v in values}
    assert len(set(made.values())) == len(values) and made["29.02.2024"] == ".".join(reversed(made["2024-02-29"].split("-"))) and made["A.B@x.org"].lower() == made["a.b@x.org"]


# 6 near duplicates


def brute_near(docs, percent=85):
    sets = {i: frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []) for i, t in docs for w in [words(t)]}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and a and b and 100 * len(a & b) >= percent * len(a | b):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {i: (len(s), find(i)) for i, s in sets.items()}


def family(rng, n, edits):
    base = [f"u{k}" for k in range(150)]
    out = []
    for d in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(6)
    texts = family(rng, 60, 7) + invented(rng, 20) + ["a b c", "A  b\tc", "a b c d", "", None, "one"]
    docs = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(docs, DOCS)).collect()}
    assert got == brute_near(docs)


def test_blocks_find_what_the_hub_leaves(spark):
    rng = random.Random(7)
    docs = list(enumerate(family(rng, 50, 8)))
    df = spark.createDataFrame(docs, DOCS)
    nodes = neardup._map_sets(df, bands=False).select("doc_id", "node", F.col("n_shingles").alias("n"), "items")
    nodes = neardup.stored(nodes)
    roots = neardup.linked_roots(nodes.select(F.lit(1).cast("long").alias("bucket"), "node", "n").distinct(), nodes.select("node", "items").dropDuplicates(["node"]), 85, block=1500)
    got = {}
    for r in nodes.join(roots, "node", "left").collect():
        got.setdefault(r.root or r.node, set()).add(r.doc_id)
    want = {}
    for i, (_, c) in brute_near(docs).items():
        want.setdefault(c, set()).add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_linked_pairs_equal_all_pairs():
    rng = np.random.default_rng(6)
    core = rng.integers(0, 1 << 62, 120, dtype=np.uint64)
    for percent in (80, 85):
        sets = [np.unique(np.concatenate([rng.permutation(core)[: rng.integers(80, 121)], rng.integers(0, 1 << 62, rng.integers(0, 25), dtype=np.uint64)])) for _ in range(120)] + [core[:1], core[:1], core[1:3]]
        at = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
        stray, root = rng.random(len(sets)) < 0.5, rng.integers(0, 60, len(sets))
        plain = [set(x.tolist()) for x in sets]
        want = {(max(i, j), min(i, j)) for i, x in enumerate(plain) for j, y in enumerate(plain[:i]) if (stray[i] or stray[j]) and root[i] != root[j] and 100 * len(x & y) >= percent * len(x | y)}
        got = neardup.linked_pairs(np.concatenate(sets), at, percent, stray, root)
        assert {(max(p), min(p)) for p in got} == want and len(got) == len(want) > 20


def test_memory_of_a_block_of_short_sets(spark):
    """A bucket of 20,000 unlinked sets of ten: blocks are bounded by sets as well as by shingles."""
    import tracemalloc

    rng = np.random.default_rng(7)
    sets = [np.sort(rng.choice(4000, 10, replace=False)).astype(np.uint64) for _ in range(2 * 1000)]
    at = np.arange(len(sets) + 1) * 10
    tracemalloc.start()
    neardup.linked_pairs(np.concatenate(sets), at, 85, np.ones(len(sets), bool), np.arange(len(sets)))
    assert tracemalloc.get_traced_memory()[1] < 300 << 20
    tracemalloc.stop()


def test_near_duplicates_of_odd_and_empty(spark, odd):
    rows = neardup.near_duplicates(odd).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == odd.count() and got[9].component_id == 4 and got[7].component_id == 5 and got[None].component_id is None and got[None].kept
    assert got[1].n_shingles == 0 and got[1].kept and [r.kept for r in rows if r.doc_id == 5] == [True, True]
    assert neardup.near_duplicates(odd.limit(0)).count() == 0


# 7 exact duplicates


def test_filters_hold_every_key():
    rng = np.random.default_rng(7)
    for n in (0, 1, 2, 3, 50, 1000, 30_000):
        keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        made = exactdup.fuse_build(keys)
        assert exactdup.fuse_contains(made, keys).all()
        if n >= 1000:
            assert exactdup.fuse_contains(made, rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)).mean() < 0.01


@pytest.mark.parametrize("bits", [64, 1])
def test_exact_duplicates_equal_brute_force(spark, bits):
    rng = random.Random(bits)
    texts = invented(rng, 12, (1, 4))
    docs = [(i, rng.choice([*texts, None, "", "É", "É"])) for i in range(80)]
    got = as_dict(exactdup.table_duplicates(spark.createDataFrame(docs, DOCS), digest_of=lambda sha: F.substring(sha, 1, bits), bucket=5))
    groups = {}
    for i, t in docs:
        groups.setdefault(t or "", []).append(i)
    for i, t in docs:
        g = groups[t or ""]
        assert (got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) == (max(g), len(g), i == max(g))


def test_batch_without_a_snapshot_is_dealt_to_buckets(spark):
    docs = [(i, f"text {i % 90}") for i in range(200)]
    df = spark.createDataFrame(docs, DOCS)
    for snapshot in (None, df.limit(0), df.where("doc_id < 3")):
        got = {r.doc_id: (r.keep_id, r.group_size) for r in exactdup.exact_duplicates(df.where("doc_id >= 3"), snapshot, bucket=4).collect()}
        alive = [i for i, _ in docs if i >= 3 or (snapshot is not None and snapshot.count())]
        assert got == {i: (max(j for j in alive if j % 90 == i % 90), sum(j % 90 == i % 90 for j in alive)) for i in alive}


def test_exact_duplicates_of_odd_and_empty(spark, odd):
    rows = exactdup.table_duplicates(odd).collect()
    assert len(rows) == odd.count() and {r.keep_id for r in rows if r.doc_id in (1, 2)} == {2}
    assert {r.group_size for r in rows if r.doc_id in (5, 6)} == {4} and [r.kept for r in rows if r.doc_id == 6] == [True]
    assert exactdup.table_duplicates(odd.limit(0)).count() == 0


# 8 packing


def test_bound_and_best_fit():
    rng = np.random.default_rng(8)
    for _ in range(50):
        x = rng.integers(1, 101, rng.integers(1, 60))
        bins, offset, gaps = packing.best_fit_decreasing(x, 100)
        spans = {}
        for b, o, n in zip(bins, offset, x, strict=True):
            spans.setdefault(b, []).append((o, o + n))
        for b, s in spans.items():
            s.sort()
            assert s[0][0] == 0 and all(q[0] == p[1] for p, q in zip(s, s[1:])) and s[-1][1] == 100 - gaps[b] <= 100
        assert packing.lower_bound(*np.unique(x, return_counts=True), 100) <= len(gaps)
    assert packing.lower_bound(np.array([60]), np.array([7]), 100) == 7


def test_packing_round_trip(spark, odd):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    df = odd.unionByName(odd.withColumn("doc_id", F.col("doc_id") + 100).withColumn("text", F.lit("It's ÉTÉ, n'est-ce pas?! don't_stop 12½ ÷ x²,é, a-b ...")))
    df = df.unionByName(odd.limit(2).withColumn("doc_id", F.lit(300).cast("long")).withColumn("text", F.lit("Hello <|startoftext|> World<|endoftext|>x <|STARTOFTEXT|>")))
    packed = packing.stored(packing.pack(df, group=8))
    got = packed.collect()
    ids = {}
    for r in df.collect():
        ids.setdefault(r.doc_id, []).append([*tok.encode(r.text or "", add_special_tokens=False).ids, 1])
    cut = Counter((d, k, k * 4096, len(x[k * 4096 : k * 4096 + 4096]), zlib.crc32(np.array(x[k * 4096 : k * 4096 + 4096], "<u4").tobytes())) for d, xs in ids.items() for x in xs for k in range(-(-len(x) // 4096)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == cut
    spans = {}
    for r in got:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.offset + r.length))
    assert all(s[0][0] == 0 and s[-1][1] <= 4096 and all(b[0] == a[1] for a, b in zip(s, s[1:])) for s in map(sorted, spans.values()))
    assert len(spans) <= len(packing.best_fit_decreasing(np.array([r.length for r in got]), 4096)[2])
    row = packing.certificate(packed).first()
    assert (row.bins, row.gap) == (len(spans), len(spans) - row.bound) and 0 <= row.gap <= 1
    assert packing.pack(odd.limit(0)).count() == 0


def test_packing_reaches_the_bound_from_small_partitions(spark):
    rng = np.random.default_rng(80)
    items = packing.stored(spark.createDataFrame([(i, int(n)) for i, n in enumerate(rng.integers(1, 3000, 400))], "id int, length long"))
    alone = len(packing.best_fit_decreasing(np.array([r.length for r in items.collect()]), 4096)[2])
    for group in (8, 50, 1000):
        row = packing.certificate(packing.pack_pieces(items, group=group)).first()
        assert row.bound <= row.bins <= alone


def test_other_tokenizers_are_left_to_the_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["It's two  words", "", "a<|endoftext|>b\n c"]
    tok = Tokenizer.from_file(path)
    got = {low: ids.tolist() for low, ids, at in packing.Parts(path).encode(pa.array(texts))}
    assert got == {i: [*tok.encode(t, add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}


# 9 and 10 classifiers


def test_toxicity_learns_unseen_spellings(spark):
    rng = random.Random(10)
    docs, labels = [], []
    for i in range(400):
        t, bad = invented(rng, 1, (10, 60))[0], i % 4 == 0
        if bad:
            t += " " + " ".join("grumpf" + rng.choice(["a", "el", "ish", "y", "ox"]) for _ in range(3))
        docs.append((i, t, 7, "x"))
        labels.append((i, int(bad), int(bad)))
    schema = "doc_id long, text string, score long, predicted string"
    d, y = spark.createDataFrame(docs, schema), spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    got = as_dict(toxicity.toxicity(d, y))
    held = [i for i, *_ in docs if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] == (i in held) for i in got) and np.mean([got[i]["predicted"] == (i % 4 == 0) for i in held]) > 0.95
    new = as_dict(toxicity.toxicity(d.unionByName(spark.createDataFrame([(1000, "ta ren o li grumpfett grumpfus sk", 1, "")], schema)), y))
    assert new[1000]["predicted"] == 1
    assert toxicity.keep_clean(d, y).columns == d.columns and toxicity.keep_clean(d, y).count() < 320


def test_toxicity_forward_pass_and_gradient():
    texts, labels = ["You grumpf ta-ren, it's", "ta ren o", "", "grumpf grumpf li", None, "o li sk"], np.array([1, 0, 0, 1, 0, 0])
    model = toxicity.fit(texts, labels, epochs=5, buckets=1 << 12)
    code = lambda b: int(kernels.span_hashes(kernels.prefix_hashes(np.frombuffer(b, np.uint8)), np.array([0]), np.array([len(b)]))[0]) % model["buckets"]

    def plain(text):
        found = re.findall("(?:[a-z0-9']|[^\x00-\x7f])+", (text or "").translate(LOW))
        gains = []
        for word in found:
            w = b"<" + word.encode() + b">"
            grams = [w] + [w[i : i + n] for n in (3, 4, 5) for i in range(len(w) - n + 1)]
            gains.append(np.mean([model["weights"][code(g)] for g in grams]))
        return 1 / (1 + math.exp(-(model["bias"] + (sum(gains) / len(gains) if gains else 0))))

    assert toxicity.score_texts(pa.array(texts), model) == pytest.approx([plain(t) for t in texts], rel=1e-5)
    bags = toxicity.Bags(texts, 1 << 12)
    rng = np.random.default_rng(1)
    theta = {"E": rng.normal(size=(2, len(bags.used))) * 0.01, "W": rng.normal(size=(2, 2)), "b": rng.normal(size=2)}
    _, grad = toxicity.loss_and_gradient(theta, bags, labels)
    for k, g in grad.items():
        for at in [np.unravel_index(i, g.shape) for i in range(0, g.size, max(1, g.size // 20))]:
            sides = []
            for d in (1e-3, -1e-3):
                moved = {n: v.copy() for n, v in theta.items()}
                moved[k][at] += d
                sides.append(toxicity.loss_and_gradient(moved, bags, labels)[0])
            assert (sides[0] - sides[1]) / 2e-3 == pytest.approx(g[at], rel=0.05, abs=2e-3)


def test_quality_learns_structure(spark):
    rng = random.Random(9)
    docs = [(i, t.upper().replace(" ", "!! ") if i % 3 == 0 else t, len(t)) for i, t in enumerate(invented(rng, 300, (20, 60)))]
    y = spark.createDataFrame([(i, 0, int(i % 3 > 0)) for i, *_ in docs], "doc_id long, toxic int, quality int")
    got = as_dict(quality.quality(spark.createDataFrame(docs, "doc_id long, text string, n_chars long"), y))
    held = [i for i, *_ in docs if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([got[i]["predicted"] == (i % 3 > 0) for i in held]) > 0.95


def test_pairwise_sum_equals_all_pairs():
    row, feature, value, n = quality.features(pa.array(["One two one", "x"]))
    rng = np.random.default_rng(1)
    model = {"w": rng.normal(size=quality.FEATURES), "V": rng.normal(size=(quality.FEATURES, 3)).astype(np.float32), "b": 0.3}
    margin, _ = quality._margin(model, row, feature, value, n)
    for r in range(n):
        f, x = feature[row == r], value[row == r]
        pairs = sum(float(model["V"][f[i]] @ model["V"][f[j]]) * x[i] * x[j] for i in range(len(f)) for j in range(i))
        assert margin[r] == pytest.approx(0.3 + (model["w"][f] * x).sum() + pairs, rel=1e-4)


@pytest.mark.parametrize("operator", [toxicity.toxicity, quality.quality])
def test_classifiers_of_odd_and_empty(spark, odd, operator):
    y = spark.createDataFrame([(5, 1, 1), (6, 0, 0), (None, 1, 0), (8, None, None)], "doc_id long, toxic int, quality int")
    got = operator(odd, y).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert operator(odd.limit(0), y).count() == 0 and operator(odd, y.limit(0)).count() == odd.count()

"""The pipeline against a brute-force version of its rules, on a small set of documents."""

import random
import zlib

from test_operators import brute_contamination, brute_near

import corpus_pipeline
from overlace.llm import neardup


def test_pipeline_equals_its_stages(spark, tmp_path):
    rng = random.Random(11)
    say = lambda n: " ".join("".join(rng.choice(["ta", "ren", "o", "li", "sk", "um"]) for _ in range(rng.randrange(1, 5))) for _ in range(n))
    items = [(i, say(20)) for i in range(4)]
    texts = {i: say(60) for i in range(200)}
    for i in range(0, 200, 5):
        texts[i] += " grumpfa grumpfel grumpfy"
    for i in range(101, 120, 2):
        texts[i] = texts[3]  # equal texts
    for i in range(141, 149, 5):
        texts[i] = texts[7].rsplit(" ", 2)[0] + f" changed{i} here"
    texts[161] += " " + items[1][1]
    docs = [(i, t, "en", "s", len(t)) for i, t in texts.items()]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, int(i % 5 == 0), 1) for i in range(0, 200) if i % 3], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")

    left = {i: t for i, t in texts.items() if i % 5}
    last = {}
    for i, t in left.items():
        last[t] = i
    left = {i: t for i, t in left.items() if last[t] == i}
    near = brute_near(list(left.items()))
    left = {i: t for i, t in left.items() if near[i][1] == i}
    dirty = {d for d, *_, bad in brute_contamination(list(left.items()), items) if bad}
    got = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == set(left) - dirty and 161 not in got and len([i for i in range(101, 120, 2) if i in got]) == 1
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
    assert zlib.crc32(b"1")


def test_near_stage_drops_copies_from_0_8(spark):
    # 104 words are 100 shingles; another last half of n words leaves J = (100 - n) / (100 + n): 0.835, 0.802, 0.786.
    said = [f"w{i}" for i in range(104)]
    docs = [(k, " ".join(said[: 104 - n] + [f"x{k}y{i}" for i in range(n)])) for k, n in enumerate((0, 9, 11, 12))]
    got = {r.doc_id for r in corpus_pipeline.near_stage(spark, spark.createDataFrame(docs, "doc_id long, text string"), None).collect()}
    assert got == {0, 3}
    assert (1 - 0.8**neardup.ROWS) ** neardup.BANDS < 1e-4


def odd_tables(spark, folder, rows):
    kinds = "doc_id long, text string, lang string, source string, n_chars long, node string, items string, task string, _row string"
    spark.createDataFrame([(i, t, None, None, None, "a", "b", "c", "d") for i, t in rows], kinds).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, LONG[:200]), (2, None), (3, ""), (None, "x")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(50, 1, 0), (51, 0, 1), (None, 1, 1), (52, None, None)], "doc_id long, toxic int, quality int").write.parquet(f"{folder}/labels.parquet")


LONG = " ".join(f"word{i % 613}x{i % 89}" for i in range(40_000))
SAID = "a quiet boat went down the river in the early morning light and nobody saw it go"
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, LONG), (5, SAID), (5, SAID), (6, SAID), (None, SAID), (None, None), (8, "漢字 naïve 😀"), (9, SAID.replace("quiet", "noisy") + " again and again until the evening came with rain and wind from the sea")]


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls, empty and very long texts, repeated rows, and columns with names that the operators use inside."""
    odd_tables(spark, tmp_path, ODD)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    ids = lambda df: sorted(((r.doc_id is None, r.doc_id) for r in df.collect()))
    every = sorted((i is None, i) for i, _ in ODD)
    stages = dict(corpus_pipeline.STAGES)
    exact = ids(stages["exact_dedup"](spark, docs, str(tmp_path)))
    assert exact == [(False, i) for i in (2, 3, 4, 6, 8, 9)] + [(True, None)] * 2
    near = ids(stages["near_dedup"](spark, docs, str(tmp_path)))
    assert near == [(False, i) for i in (1, 2, 3, 4, 5, 5, 8, 9)] + [(True, None)] * 2
    assert ids(stages["decontamination"](spark, docs, str(tmp_path))) == every
    for name in ("toxicity", "exact_dedup", "near_dedup", "decontamination"):
        assert stages[name](spark, docs, str(tmp_path)).columns == docs.columns
    packed = stages["packing"](spark, docs, str(tmp_path)).where("piece = 0")
    assert ids(packed) == every
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_stages_on_empty_tables(spark, tmp_path):
    odd_tables(spark, tmp_path, ODD[:1])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0

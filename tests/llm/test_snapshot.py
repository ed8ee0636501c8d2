"""Batches against a stored snapshot."""

import random
import shutil

import pytest

from overlace.llm import exactdup

DOCS = "doc_id long, text string, n long, top string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], DOCS)


@pytest.mark.parametrize("bucket", [7, 50_000])
def test_batches_against_a_stored_snapshot(spark, tmp_path, bucket):
    rng = random.Random(bucket)
    old = [(i, f"text {rng.randrange(120)}") for i in range(200)] + [(None, "text 1"), (900, None), (901, "")]
    folder = str(tmp_path / "snapshot")
    exactdup.build_snapshot(frame(spark, old), folder, bucket=bucket)
    shutil.move(f"{folder}/texts", f"{folder}/away")
    news = [(i, f"new {i % 9}") for i in range(300, 340)]
    got = exactdup.against_snapshot(frame(spark, news), folder, bucket=bucket)
    # Filters leave few false positives, and without a digest found no text is opened.
    assert {(r.doc_id, r.keep_id, r.group_size, r.in_snapshot) for r in got.collect()} == {(i, max(j for j, u in news if u == t), sum(u == t for _, u in news), False) for i, t in news}
    shutil.move(f"{folder}/away", f"{folder}/texts")
    batch = [(i, f"text {rng.randrange(200)}") for i in range(100, 160)] + [(None, "text 2"), (None, "fresh"), (5, ""), (6, "text 3"), (6, "text 3")]
    got = exactdup.against_snapshot(frame(spark, batch), folder, bucket=bucket).collect()
    assert len(got) == len(batch)
    texts = {i: t or "" for i, t in batch}
    for r in got:
        if r.doc_id is None:
            continue
        same = [i for i, t in old + batch if (t or "") == texts[r.doc_id]]
        assert (r.keep_id, r.group_size, r.kept) == (max(i for i in same if i is not None), len(same), r.doc_id == max(i for i in same if i is not None))
        assert r.in_snapshot == any((t or "") == texts[r.doc_id] for _, t in old)
    assert [r.keep_id for r in got if r.doc_id is None and not r.in_snapshot] == [None]


def test_empty_snapshots_and_batches(spark, tmp_path):
    empty = frame(spark, []).limit(0)
    exactdup.build_snapshot(empty, str(tmp_path / "none"))
    rows = exactdup.against_snapshot(frame(spark, [(1, "a"), (2, "a")]), str(tmp_path / "none")).collect()
    assert {(r.doc_id, r.keep_id, r.in_snapshot) for r in rows} == {(1, 2, False), (2, 2, False)}
    exactdup.build_snapshot(frame(spark, [(1, "a")]), str(tmp_path / "one"))
    assert exactdup.against_snapshot(empty, str(tmp_path / "one")).count() == 0

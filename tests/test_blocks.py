"""Files of the streams: bounded rows in each, however many overlaps there are, in a bounded number of triggers."""

import glob

import pyarrow.parquet as pq
import pytest
from helpers import SMALL, table

import __spark_entry__ as entry
from overlace.plans import streams


@pytest.mark.parametrize("name", ["t1_ingest_blocks", "t3_accumulate_coverage", "t4_live_masks", "t6_checkpoint_resume"])
def test_files_have_bounded_rows(spark, duck, name, monkeypatch):
    monkeypatch.setattr(streams, "FILE", 200)
    folders = lambda: set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/overlace-stream-*"))
    before = folders()
    got = entry.queries()[name](spark, SMALL)
    rows = [tuple(r) for r in got.collect()]
    (made,) = folders() - before
    sizes = [pq.read_metadata(f).num_rows for f in glob.glob(f"{made}/blocks/*.parquet")]
    assert len(sizes) > 20 and max(sizes) <= 300
    assert len(glob.glob(f"{made}/state/commits/[0-9]*")) <= 10
    want = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert table(rows, got.columns) == table(want.fetchall(), names)

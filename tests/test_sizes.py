"""What plans do with tables that grow: no broadcast of rows made from a small table, no shuffle of segments."""

import re

import pytest
from helpers import SMALL

from overlace.plans import registry

registry.load()


def plan(spark, name: str) -> str:
    return registry.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["c11_outside_patches", "c11_segment_patches", "r2_tile_rank"])
def test_qualities_are_not_broadcast(name, spark):
    assert not re.search(r"BroadcastHashJoin \[(bread#\w+, b_seg|aread#\w+, seg)", plan(spark, name))


@pytest.mark.parametrize("name", ["r1_tiles"])
def test_segments_are_not_shuffled(name, spark):
    above = plan(spark, name).split("Generate explode(sequence", 1)[0]
    assert "Exchange" not in above


@pytest.mark.parametrize("name", ["a8_segment_quality", "p11_trim_leading_indels", "j11_project_interval_via_trace"])
def test_segments_are_not_dealt_by_overlap(name, spark):
    assert not re.search(r"hashpartitioning\(ovl_id#\w+, \d", plan(spark, name))


@pytest.mark.parametrize("name", ["j1_kmer_seed_join", "j2_self_rules", "j4_symmetric_emit", "j5_diagonal_band_filter", "j6_align_candidates", "j7_redundancy_removal"])
def test_kmers_are_not_shuffled_one_by_one(name, spark):
    """Stretches of k-mers go to buckets; neither a k-mer's number nor single seeds are dealt."""
    found = plan(spark, name)
    assert "hashpartitioning(bucket" in found and "hashpartitioning(code" not in found
    assert not re.search(r"hashpartitioning\(aread#\w+L?, bread#\w+L?, comp#\w+, panel#\w+L?, band", found)


@pytest.mark.parametrize("name", ["r3_tile_texts", "r3_tile_consensus", "r5_position_map", "r4_assemble_corrected"])
def test_tiles_meet_reads_once(name, spark):
    """Segments aren't dealt by overlap or B read; tiles go to their pieces and back."""
    found = plan(spark, name)
    assert not re.search(r"hashpartitioning\(ovl_id#\w+, \d", found)
    assert not re.search(r"hashpartitioning\(bread#\w+, \d+\)[^\n]*\n[^\n]*Project \[[^\n]*seg#", found)

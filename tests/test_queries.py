"""Registered queries against DuckDB on the smallest tables.

By default one of every kind of operator; with OVERLACE_ALL=1 every query of the library.
"""

import os

import pytest
from helpers import SMALL, table

from overlace.plans import registry

registry.load()
SOME = """w1_coverage_sweep w2_repeat_hysteresis w4_local_end_repeats w12_window_gap_check a9_mode_coverage i1_combine i5_invert_anchors i6_tip_merge j10_interval_intersect
p4_local_alignment p6_nonrepeat_bases p7_merge_tip_repeats p10_segment_error p12_trim_overlaps p14_symmetric_discard p18_mito_filter j11_project_interval_via_trace w11_drop_containments
w17_worst_alignments w20_proper_pair_only a2_length_histogram a3_overlap_stats a8_segment_quality w8_trim_by_quality a14_n50_stats r15_best_subread r17_five_prime_filter a13_kmer_suppression
j5_diagonal_band_filter w6_dust_mask g2_classify_reads g3_make_edges g6_components g11_best_next c4_stitch_fuzz i9_repeat_modules r12_trim_contigs
s1_read_fasta s15_path_lines k1_write_fasta w23_split_long_reads t4_emit_masks w3_repeat_edge_extension w14_chimer_walls w15_chimer_spans c7_missed_adapter_trim c9_gap_patches c10_distinct_patches
c11_segment_patches c12_apply_patches c12_converted_intervals r3_tile_texts r10_classify_contigs r14_classified_report p7_tip_window p8_anchor_bases_lowcomp p16_flagged_identity_filters o2_order_checks
o3_concatenate_split o5_take_n o6_union_anti_semi overlap_scan k8_read_lists t2_merge_multi_hits t6_checkpoint_resume j2_self_rules j6_align_candidates j8_tandem_self_join w24_restriction_sites
w9_tighten_by_quality w10_weak_runs w10_break_drops w15_walked_chimers recipe_coverage recipe_mask_patched recipe_filter recipe_scrub recipe_patch_reads recipe_analyse_contigs recipe_organelle_reads""".split()
NAMES = sorted(registry.SQL) if os.environ.get("OVERLACE_ALL") else SOME


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(name, spark, duck):
    df = registry.QUERIES[name](spark, SMALL)
    found = duck.execute(registry.SQL[name])
    names = [d[0] for d in found.description]
    assert table([tuple(r) for r in df.collect()], df.columns) == table(found.fetchall(), names)


def test_entry_imports_without_a_session():
    import subprocess
    import sys
    from pathlib import Path

    code = "import __spark_entry__ as e; assert len(e.queries()) > 100 and set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parent.parent, check=True)

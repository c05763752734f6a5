"""Registered queries against their SQL. ALL_QUERIES=1 runs every one of them."""

import os

import check
import pytest

import __spark_entry__ as entry

SAMPLE = """a1_bag_counts a2_bag_merge a3_active_slots a5_union_sets a6_cap_records a7_union_families a12_label_conflict
a13_latest_identifier a14_every_period a15_modal_value a16_within_row_counts e1_auc e2_accuracy e3_label_coverage
f1_entropy_brand f1_entropy_tokens f2_chi_entropy_gini f4_fnv1a f5_simhash_documents f6_activity_fingerprint_64 f8_onehot_lines
f11_tag_encode f12_tag_count_encode f14_libsvm_labelled f16_libsvm_labelled_keyed f17_triples f18_session_explode g3_intersection
g4_layout_union geo3_locate geo4_locate_single_box geo6_rollup geo7_areas_per_entity geo8_names_labelled geo9_enrich
j3_left_default j4_dictionary_chain j5_tag_schema j7_hour_items_labelled m2_balanced_ratio m3_repeated_holdout m6_tag_scores
m7_pseudo_labels m9_batched_tagging p4_malformed_rows p5_missing_defaults p6_json_fields p12_kv_log s4_framed_binary
s8_json_by_day t2_vocab_top w1_entropy_row_rank w2_entropy_dense_rank w3_average_ranks w4_vocab_index c1_dbscan""".split()


@pytest.fixture(scope="module")
def con(folder):
    return check.connect(folder)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()) if os.environ.get("ALL_QUERIES") else SAMPLE)
def test_matches_sql(spark, con, folder, name):
    ok, note = check.compare(spark, con, name, folder)
    assert ok, note


def test_catalogue_is_consistent():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(SAMPLE) <= set(entry.oracle_sql())


def test_entry_has_stable_schema(spark):
    assert entry.entry(spark).dtypes == [("item", "string"), ("pos", "bigint"), ("n", "bigint"), ("entropy", "double")]

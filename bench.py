"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names (default: the list below)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tagmill.plans.catalogue import QUERIES  # noqa: E402
from tagmill.session import build  # noqa: E402

HEADLINE = [
    "f1_entropy_tokens", "f1_entropy_brand", "w1_entropy_row_rank", "w2_entropy_dense_rank", "f2_chi_entropy_gini",
    "f17_triples", "w4_vocab_index", "t2_vocab_top", "f8_onehot", "f10_count_encode", "f11_tag_encode",
    "f13_libsvm_build", "f5_simhash_documents", "f7_activity_fingerprint_256", "f18_session_explode",
    "a1_bag_counts", "a2_bag_merge", "a6_cap_records", "a13_latest_identifier", "a15_modal_value",
    "j2_label_inner", "j4_dictionary_chain", "g3_intersection", "m2_balanced", "m3_repeated_holdout",
    "m5_train_score", "m6_tag_scores", "m11_stack", "e1_auc", "geo3_locate", "geo8_names_per_entity", "c1_dbscan",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build("tagmill-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/nation.parquet").count()
    cold, warm = {}, {}
    for name in names:
        for times in (cold, warm):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - started, 3)
        spark.catalog.clearCache()
    print(json.dumps({"metric": "headline queries, warm run, summed", "value": round(sum(warm.values()), 3), "unit": "sec",
                      "queries": warm, "cold": cold, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()

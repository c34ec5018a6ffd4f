"""Times queries and prints one JSON line.

``BENCH_SF_DIR`` is the table folder, ``BENCH_CPUS`` the local cores, ``BENCH_ALL=1`` runs every
query, ``BENCH_ONLY`` a comma-separated list, ``BENCH_WARM=1`` reports a second run of each.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from maskloom.plans import all_queries  # noqa: E402
from maskloom.session import local_session  # noqa: E402

HEADLINE = [
    "class_balance_report", "class_size_reference", "confusion_metrics", "region_geometry_2d", "mask_quality_reasons", "audit_badness", "triage",
    "composite_score", "connected_components", "absorb_small_components", "mask_overlap", "joint_in_label_rate", "assign_nearest", "union_masks",
    "soften_labels", "boundary_cells", "occlusion_rect_pairs", "stratified_split", "incremental_split", "merge_datasets", "map_name_cascade",
    "world_transform", "leaderboard", "review_queue", "status_transitions", "daily_streaks", "clip_summary", "action_norms", "extreme_frames",
    "uniform_arc_resample", "drop_anticipation", "shape_drift_check", "multiview_consistency", "proportion_features", "impute_scale",
    "vertex_features", "dominant_region", "probability_ensemble", "segment_vote", "validate_dataset", "view_triplets", "complete_view_sets",
    "first_reject_reason", "export_coco", "running_metrics", "kmeans_select_k", "scan_per_example", "worst_angle_pairs", "degradation_pairs",
    "mask_quality_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries.queries()
    names = list(queries) if os.environ.get("BENCH_ALL") else HEADLINE
    if os.environ.get("BENCH_ONLY"):
        names = os.environ["BENCH_ONLY"].split(",")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("sum(l_quantity)").collect()  # start the session
    times: dict[str, float] = {}
    for name in names:
        for _ in range(2 if os.environ.get("BENCH_WARM") else 1):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total query time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

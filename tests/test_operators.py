"""Hand-computed cases."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from maskloom import dims
from maskloom.functions import geometry as G
from maskloom.functions import names as N
from maskloom.operators import assets as A
from maskloom.operators import layers as L
from maskloom.operators import masks as M
from maskloom.operators import measurements as X
from maskloom.operators import merge as H
from maskloom.operators import quality as Q
from maskloom.operators import review as R
from maskloom.operators import series as S
from maskloom.operators import splits as J
from maskloom.operators import weights as W


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_confusion(spark):
    gt, pred = [0, 0, 0, 1, 1, 1, 2, 2], [0, 0, 1, 1, 1, 1, 0, 2]
    df = spark.createDataFrame([("e", g, p, 1) for g, p in zip(gt, pred)] + [("e", -1, 0, 9), ("e", 40, 0, 9)], "example string, gt int, pred int, w long")
    iou = {r.class_id: r.iou for r in M.confusion_metrics(df).collect()}
    assert iou == {0: 0.5, 1: 0.75, 2: 0.5}
    s = M.segmentation_summary(df).first()
    assert round(s.miou, 4) == 0.5833 and s.pixel_accuracy == 0.75


def test_class_shares_of_three_bands(spark):
    bands = [(y, c) for c, y0 in ((0, 0), (1, 16), (3, 32), (5, 48)) for y in range(y0, y0 + 16) for c in [c]]
    df = spark.createDataFrame([("d", e, y, 0, 64, c) for e in range(4) for y, c in bands], "dataset string, example_id int, y int, x0 int, len int, class_id int")
    shares = {r.class_id: r.share for r in M.class_distribution(df).collect() if r.share}
    assert shares == {1: 0.3333, 3: 0.3333, 5: 0.3333}
    assert M.coverage_gaps(M.class_distribution(df)).count() == 18
    weights = {r.class_id: r.weight for r in M.median_frequency_weights(df).collect()}
    assert weights[1] == 1.0 and weights[2] == 0.0
    geo = {r.region: r for r in M.region_geometry_2d(df.where("example_id = 1")).collect()}
    assert (geo["head"].apparent_width, geo["head"].apparent_height, geo["head"].y_min) == (64, 16, 16)
    assert geo["neck"].visible is False and geo["neck"].x_min is None
    reasons = Q.mask_quality_reasons(df, Q.MaskRules(drop_head_below_torso=True)).first().reasons
    assert reasons == ["too_few_regions"]


def test_empty_mask_scores(spark):
    df = spark.createDataFrame([("d", 1, 0, 0, 64, 0)], "dataset string, example_id int, y int, x0 int, len int, class_id int")
    assert Q.mask_quality_reasons(df).first().reasons == ["low_foreground", "no_foreground"]
    assert Q.audit_badness(df).first().badness == 1.0
    assert Q.triage(df).first().decision == "reject"


def test_character_ids(spark):
    want = {
        "mixamo_001_pose_05_flat": "mixamo_001", "fbanimehq_0000_000005": "fbanimehq_0000", "stdgen_0042_front": "stdgen_0042",
        "animerun_clip01_000005": "animerun_clip01", "humanrig_00000_t_pose_01_front": "humanrig_00000", "other": "other",
    }
    df = spark.createDataFrame([(k,) for k in want], "e string").withColumn("c", N.character_id(F.col("e")))
    assert {r.e: r.c for r in df.collect()} == want


def test_longest_style_and_angle(spark):
    df = spark.createDataFrame([("a_pose_01_three_quarter_back_soft_cel",), ("b_pose_00_ink_wash",)], "stem string").withColumns(N.parse_stem())
    assert rows(df, "p_char", "p_pose", "p_angle", "p_style") == [("a", "01", "three_quarter_back", "soft_cel"), ("b", "00", "front", "ink_wash")]


def test_tokens(spark):
    cases = {"mixamorig:LeftForeArm": ["left", "fore", "arm"], "hand.L": ["hand", "left"], "Spine.001": ["spine"], "DEF-thigh_r_02": ["thigh", "right"]}
    df = spark.createDataFrame([(k,) for k in cases], "n string").withColumn("t", N.tokenize_name(F.col("n")))
    assert {r.n: r.t for r in df.collect()} == cases


def greedy(counts, new, ratios):
    c = dict(counts)
    for _ in range(new):
        total = sum(c.values())
        best = "train" if total == 0 else max(ratios, key=lambda k: ratios[k] - c[k] / total)
        c[best] += 1
    return c


@pytest.mark.parametrize("have", [(0, 0, 0), (5, 50, 2), (100, 0, 0), (8, 1, 1), (0, 30, 30)])
def test_incremental_split_is_within_one_of_the_greedy_loop(spark, have):
    ratios = dims.SPLIT_RATIOS
    old = [(f"o{k}{i}", k) for k, n in zip(ratios, have) for i in range(n)]
    new = random.Random(sum(have)).randint(5, 90)
    existing = spark.createDataFrame(old, "char_id string, split string")
    chars = spark.createDataFrame([(f"n{i}",) for i in range(new)], "char_id string")
    out = J.incremental_split(chars, existing)
    got = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    want = greedy(dict(zip(ratios, have)), new, ratios)
    assert all(abs(got.get(k, 0) - want[k]) <= 1 for k in ratios)
    kept = {(r.char_id, r.split) for r in out.where("NOT is_new").collect()}
    assert kept == set(old)


def test_stratified_split_counts(spark):
    chars = spark.createDataFrame([(f"{s}{i}", s) for s, n in (("a", 25), ("b", 3), ("c", 400)) for i in range(n)], "char_id string, source string")
    out = J.stratified_split(chars, seed=1).cache()
    n = {(r.source, r.split): r["count"] for r in out.groupBy("source", "split").count().collect()}
    assert n[("a", "train")] == 20 and n[("a", "val")] == 2 and n[("c", "train")] == 320 and n[("c", "val")] == 40
    assert J.split_leaks(out).count() == 0
    assert rows(out, "char_id", "split") == rows(J.stratified_split(chars.repartition(13), seed=1), "char_id", "split")


def test_merge_of_three_sources(spark):
    chars = spark.createDataFrame(
        [("x", "a", 1, True), ("x", "a", 2, True), ("x", "b", 3, True), ("b_x", "c", 4, True), ("y", "a", 1, False), ("y", "b", 2, True)],
        "char_id string, source string, source_rank int, ok boolean",
    )
    out = H.merge_characters(chars, F.when(~F.col("ok"), "no_files"))
    got = {(r.char_id, r.source, r.source_rank): (r.status, r.merged_id) for r in out.collect()}
    assert got[("x", "a", 1)] == ("kept", "x") and got[("x", "a", 2)] == ("duplicate", None)
    assert got[("b_x", "c", 4)] == ("kept", "b_x") and got[("x", "b", 3)] == ("renamed", "b_x_2")
    assert got[("y", "a", 1)] == ("no_files", None) and got[("y", "b", 2)] == ("kept", "y")


def clip(spark, xs, frame_time=1 / 30):
    return spark.createDataFrame([(1, i, float(x), 0.0, 0.0, frame_time) for i, x in enumerate(xs)], "clip int, frame int, px double, py double, pz double, frame_time double")


def test_motion_timing(spark):
    v = [r.speed for r in S.root_velocity(clip(spark, [0, 1, 3, 6, 10])).orderBy("frame").collect()]
    assert [round(x, 6) for x in v] == [0, 30, 60, 90, 120]
    assert S.root_velocity(clip(spark, [4])).count() == 0
    still = S.timing_phases(S.root_velocity(clip(spark, [2, 2, 2]))).first()
    assert still.hold_ratio == 1.0 and still.accel_frames == 0
    walk = S.clip_summary(clip(spark, [0, 1, 3, 6, 10], 0.0)).first()
    assert walk.frame_rate == 30.0 and walk.acceleration_ratio == 0.8 and walk.hold_ratio == 0.2


def test_anticipation(spark):
    ys = [0, -4, -8, 0, 10, 20, 30, 40, 50, 50]
    df = spark.createDataFrame([(1, i, "hips", 0.0, float(y), 0.0) for i, y in enumerate(ys)], "clip int, frame int, bone string, rx double, ry double, rz double")
    assert rows(S.anticipation_frames(df), "frame") == [(1,), (2,)]


def test_decimate_keeps_last(spark):
    df = spark.createDataFrame([(1, i, "hips", float(i), 0.0, 0.0) for i in range(6)], "clip int, frame int, bone string, rx double, ry double, rz double")
    assert rows(S.decimate_frames(df, 2), "frame", "rx") == [(0, 0.0), (1, 2.0), (2, 4.0), (3, 5.0)]


def test_lock_passes_the_chain_on(spark):
    df = spark.createDataFrame([(1, 0, b, float(i), 0.0, 0.0) for i, b in enumerate(["hips", "spine", "chest"])], "clip int, frame int, bone string, rx double, ry double, rz double")
    assert rows(S.lock_to_parent(df, ["spine", "chest"]), "bone", "rx") == [("chest", 0.0), ("hips", 0.0), ("spine", 0.0)]
    assert rows(S.lock_to_parent(df, ["chest"]), "bone", "rx") == [("chest", 1.0), ("hips", 0.0), ("spine", 1.0)]


def test_streaks(spark):
    days = [dt.datetime(2024, 1, d) for d in (1, 2, 3, 5, 6)]
    df = spark.createDataFrame([(1, d) for d in days + days[:2]], "user_id int, created_at timestamp")
    r = R.daily_streaks(df).first()
    assert (r.current_streak, r.longest_streak) == (2, 3)


def test_view_pairs_and_area_deviation(spark):
    data = [("c", 0, a, "head", w, 5, n, n > 0) for a, w, n in (("front", 10, 100), ("side", 9, 120), ("back", 4, 40))]
    m = spark.createDataFrame(data, "char_id string, pose int, angle string, region string, apparent_width int, apparent_height int, pixel_count long, visible boolean")
    assert rows(X.angle_pairs(m), "angle_a", "angle_b") == [("front", "side")]
    truth = spark.createDataFrame([("c", "head", 1.0, 1.0, 1.0)], "char_id string, region string, width double, depth double, height double")
    report = {r["check"]: (r.passed, r.failed) for r in X.check_report(X.multiview_checks(m, truth)).collect()}
    assert report == {"region_presence": (1, 0), "pixel_area_consistency": (0, 1), "measurement_ratio": (0, 1)}


def test_proportions_need_every_torso_part(spark):
    m = spark.createDataFrame([("a", "head", 1.0, 2.0), ("a", "chest", 2.0, 1.0), ("a", "spine", 1.0, 1.0), ("a", "hips", 1.0, 2.0), ("b", "head", 1.0, 2.0), ("b", "chest", 1.0, 1.0)], "char_id string, region string, width double, height double")
    got = {r.char_id: r.head_to_body_height for r in X.proportion_features(m).collect()}
    assert got == {"a": 0.5, "b": None}


def test_joint_box_without_visible_joints(spark):
    df = spark.createDataFrame([(1, 5, 5, False, 64, 64), (2, 10, 20, True, 64, 64), (2, 30, 60, True, 64, 64)], "example_id int, x int, y int, visible boolean, img_w int, img_h int")
    assert rows(G.joint_bbox(df), "example_id", "x_min", "y_min", "x_max", "y_max") == [(1, 0, 0, 64, 64), (2, 5, 15, 35, 64)]


def test_face_tie_goes_to_the_nearest_corner(spark):
    df = spark.createDataFrame([(1, 1, 0, 5, 2.0), (1, 1, 1, 6, 1.0), (1, 2, 0, 5, 0.1), (1, 2, 1, 6, 9.0), (1, 2, 2, 6, 8.0)], "example_id int, face int, corner int, region int, dist double")
    assert rows(W.face_majority_vote(df), "face", "region") == [(1, 6), (2, 6)]


def test_overlap_across_buckets(spark):
    a = spark.createDataFrame([(1, 0, 0, 200)], "example_id int, y int, x0 int, len int")
    b = spark.createDataFrame([(1, 0, 10, 3), (1, 0, 60, 100), (1, 1, 0, 9)], "example_id int, y int, x0 int, len int")
    assert L.mask_overlap(a, b).first().pixels == 103


def test_soft_labels_sum_to_one_and_stay_hard_inside(spark):
    cells = spark.createDataFrame([(1, x, y, 1 if x < 6 else 2) for x in range(12) for y in range(12)], "example_id int, x int, y int, class_id int")
    out = L.soften_labels(cells, 12, 12).toPandas()
    assert (out.groupby(["x", "y"]).p.sum() - 1).abs().max() < 1e-9
    assert len(out[(out.x == 0)]) == 12 and len(out[(out.x == 5) & (out.y == 5)]) == 2


def test_world_transform_of_a_long_chain(spark):
    bones = spark.createDataFrame([(1, i, i - 1 if i else None, 1.0, 0.0, 90.0 if i == 0 else 0.0, 1.0, 1.0) for i in range(37)] + [(1, 99, 77, 3.0, 4.0, 0.0, 1.0, 1.0)], "rig_id int, bone int, parent int, x double, y double, rotation double, sx double, sy double")
    got = {r.bone: (round(r.wx, 6), round(r.wy, 6)) for r in A.world_transform(bones).collect()}
    assert got[36] == (1.0, 36.0) and got[99] == (3.0, 4.0)
    # one rig with a cycle and a bone that hangs on it, among sound rigs of other depths
    more = [(2, 1, 2, 0.0, 0.0, 0.0, 1.0, 1.0), (2, 2, 1, 0.0, 0.0, 0.0, 1.0, 1.0), (2, 3, 2, 0.0, 0.0, 0.0, 1.0, 1.0), (2, 4, None, 0.0, 0.0, 0.0, 1.0, 1.0), (3, 1, 1, 0.0, 0.0, 0.0, 1.0, 1.0), (4, 7, None, 5.0, 6.0, 0.0, 1.0, 1.0)]
    world, cyclic = A.resolve_rigs(bones.unionByName(spark.createDataFrame(more, bones.schema)))
    assert {r.bone: (round(r.wx, 6), round(r.wy, 6)) for r in world.where("rig_id = 1").collect()} == got
    assert [tuple(r) for r in world.where("rig_id > 1").select("rig_id", "bone", "wx", "wy").collect()] == [(4, 7, 5.0, 6.0)]
    assert sorted(map(tuple, cyclic.collect())) == [(2, 1), (2, 2), (2, 3), (3, 1)]
    assert A.world_transform(bones.limit(0)).count() == 0


def test_grid_of_prompts_is_distinct(spark):
    axes = {"a": ["x", "y", "z"], "b": ["p", "q"], "c": ["1", "2", "3", "4"]}
    out = A.prompt_grid(spark.range(50).withColumnRenamed("id", "i"), "i", axes)
    assert out.count() == 50 and [out.where(f"cycle = {c}").select(*axes).distinct().count() for c in (0, 1, 2)] == [24, 24, 2]


def test_clusters_of_few_rows(spark):
    df = spark.createDataFrame([(i, *[float(i + j) for j in range(9)]) for i in range(3)], "vec_id int, " + ", ".join(f"{f} double" for f in X.FEATURES))
    out = X.label_clusters(X.kmeans_select_k(df, "vec_id", X.FEATURES)).first()
    assert (out.k, out.n, out.silhouette) == (1, 3, None)


def test_material_rules(spark):
    want = {"N00_Shoes_foot_L": "foot_l", "Right_UpperArm": "upper_arm_r", "fore_arm.r": "forearm_r", "Hair_back": "head", "Outfit_Upper": "chest", "cape_l": "background", "zzz": "UNMAPPED"}
    from maskloom.functions.bone_tables import MATERIAL_RULES

    df = spark.createDataFrame([(k,) for k in want], "n string").withColumn("r", N.first_rule(F.col("n"), MATERIAL_RULES))
    assert {r.n: r.r for r in df.collect()} == want


def test_even_sample_of_one_row(spark):
    df = spark.createDataFrame([("a",)], "k string")
    assert A.even_sample(df, "k", 5).count() == 1 and A.even_sample(df, "k", 1).count() == 1


def test_glob():
    assert A.glob_regex("**/ortho/*.png") == r"^(?:.*/)?ortho/[^/]*\.png$"


def test_all_angles_are_told_apart(spark):
    stems = {
        "c_pose_00_front_high_cel": "front_high", "c_pose_00_iso_front_cel": "iso_front", "c_pose_00_topdown_left_cel": "topdown_left", "c_pose_00_side_low_cel": "side_low",
        "c_pose_00_iso_back_left_flat": "iso_back_left", "c_pose_00_cel": "front", "c_pose_00_worms_eye_cel": None, "no pose": None,
    }
    df = spark.createDataFrame([(k,) for k in stems], "stem string").withColumns(N.parse_stem()).withColumn("unknown", N.unknown_angle())
    got = {r.stem: r for r in df.collect()}
    assert {k: r.p_angle for k, r in got.items()} == stems
    assert [k for k, r in got.items() if r.unknown == "worms_eye"] == ["c_pose_00_worms_eye_cel"]
    views = spark.createDataFrame([("c", a, a + ".png") for a in ("front", "iso_front", "topdown_left")], "char_id string, angle string, path string")
    assert A.view_triplets(views).count() == 3


def test_contains_match_is_contains(spark):
    import random

    rnd = random.Random(3)
    word = lambda lo, hi: "".join(rnd.choice("abé_") for _ in range(rnd.randrange(lo, hi)))
    stems = [(f"/m/{i:03d}", word(0, 14)) for i in range(120)] + [("/m/a", "the exact name"), ("/m/b", "name")]
    ids = [(w,) for w in {word(0, 8) for _ in range(150)} | {"exact name", "name", "no such id", "", "\u00e9"}] + [(None,)]
    got = A.contains_match(spark.createDataFrame(ids, "char_id string"), spark.createDataFrame(stems, "path string, stem string")).collect()
    assert len(got) == len(ids)
    for r in got:
        want = min((p for p, s in stems if r.char_id and r.char_id in s), default=None)
        assert r.path == want, r


def test_contains_match_never_broadcasts_its_index(spark, tmp_path, monkeypatch):
    import re

    models = spark.range(300).selectExpr("concat('/m/', id) AS path", "concat('some longer stem of a model ', id) AS stem")
    models.write.parquet(str(tmp_path / "models"))
    models = spark.read.parquet(str(tmp_path / "models"))  # a small file, as the planner sees it
    items = spark.createDataFrame([(f"model {i}",) for i in range(40)] + [("no such id",)], "char_id string")
    for few in (50_000, 0):
        monkeypatch.setattr(A, "FEW_IDS", few, raising=False)
        out = A.contains_match(items, models)
        plan = out._jdf.queryExecution().sparkPlan().toString()
        assert "Join [_gram" in plan and not re.search(r"BroadcastHashJoin \[_gram#\d+\], \[_gram#\d+\], Inner, BuildRight", plan), plan
        assert {r.char_id: r.path for r in out.collect()} == {f"model {i}": f"/m/{i}" for i in range(40)} | {"no such id": None}


def test_groups_stay_dealt_over_all_tasks(spark):
    from maskloom.operators import weights as W

    runs = spark.range(400).selectExpr("id % 40 AS example_id", "CAST(id % 3 AS INT) AS y", "CAST(id % 50 AS INT) AS x0", "2 AS len")
    views = spark.range(400).selectExpr("id % 40 AS example_id", "id % 3 AS pixel", "id % 4 AS view", "CAST(id % 5 AS INT) AS class_id", "0.5D AS p")
    for out in (L.union_masks(runs), W.probability_ensemble(views)):
        assert out.groupBy(F.spark_partition_id()).count().count() > 4  # small groups would be merged into one task


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_soft_labels_fill_absent_cells_and_shuffle_cells_once(spark):
    cells = spark.createDataFrame([(e, x, y, (e + x * y) % 5) for e in range(3) for x in range(7) for y in range(5) if (x + 2 * y + e) % 3], "example_id int, x int, y int, class_id int")
    out = L.soften_labels(cells, 7, 5, radius=1, absent=0)
    keyed = lambda df: {r[:4]: round(r.p, 9) for r in df.select("example_id", "x", "y", "class_id", "p").collect()}
    assert keyed(out) == keyed(L.soften_labels(L.densify(cells, 7, 5), 7, 5, radius=1)) and out.select("example_id", "x", "y").distinct().count() == 105
    assert plan_of(out).count("Exchange") == 1


def test_vertices_meet_the_bones_after_all_exchanges(spark):
    w = spark.createDataFrame([(e, v, v, e, f"b{(v + k) % 4}", 1.0 + k) for e in range(2) for v in range(5) for k in range(2)], "example_id int, vertex int, x int, y int, bone string, w double")
    out = G.vertex_features(w, W.weighted_joint_centroids(w), ["b0", "b1", "b9"])
    plan = plan_of(out)
    assert plan.index("Generate explode") < plan.index("Exchange")
    got = {r[:3]: r for r in out.select("example_id", "vertex", "bone", "weight", "distance").collect()}
    assert len(got) == 30 and round(got[(0, 0, "b1")].weight, 6) == 0.666667 and got[(0, 0, "b9")].weight == 0


def test_occlusion_rectangles_are_made_per_example_not_per_run(spark):
    runs = spark.createDataFrame([(e, y, 0, 40) for e in (1, 2, None) for y in range(64)], "example_id long, y int, x0 int, len int")
    out = L.occlusion_rect_pairs(runs, 64, 64)
    plan = plan_of(out)
    assert min(plan.index(j) for j in ("MergeJoin", "HashJoin") if j in plan) < plan.index("md5(")
    assert {r.example_id for r in out.collect()} <= {1, 2, None} and out.where("fg_px <> 2560").isEmpty()


def test_segments_meet_the_joints_of_their_image_in_one_join(spark):
    segments = spark.createDataFrame([(1, 5, y, 0, 10) for y in range(4)] + [(1, 6, y, 20, 10) for y in range(4)] + [(2, 5, y, 0, 10) for y in range(4)], "example_id int, segment int, y int, x0 int, len int")
    joints = spark.createDataFrame([(1, 3, 9, 0), (1, 4, 11, 2), (1, 8, 24, 1), (1, 9, 24, 3), (1, 9, 60, 3)], "example_id int, class_id int, x int, y int")
    out = L.assign_nearest(segments, joints, 64, 64)
    assert {(r.example_id, r.segment): r.region for r in out.where("example_id = 1").collect()} == {(1, 5): 3, (1, 6): 8} and out.count() == 3
    assert plan_of(out).count("Join") == 1


def test_degradations_take_the_length_of_a_clip_once(spark):
    """Frames that carry the length of their clip are not joined with it again, and locked bones meet only the bones they take from."""
    frames = spark.createDataFrame([(1, f, b, float(f), 0.0, 0.0, 9) for f in range(9) for b in ("hips", "spine")], "clip long, frame int, bone string, rx double, ry double, rz double, n_frames int")
    assert S.with_length(frames) is frames
    short = S.decimate_frames(frames).collect()
    assert sorted((r.frame, r.bone, r.rx) for r in short) == sorted((i, b, 2.0 * i) for i in range(5) for b in ("hips", "spine"))
    plan = S.lock_to_parent(frames, ["spine"])._jdf.queryExecution().optimizedPlan().toString()
    assert "= hips)" in plan

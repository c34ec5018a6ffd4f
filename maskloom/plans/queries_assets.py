"""Queries over file names, artifacts, documents and work lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from maskloom import dims
from maskloom.functions.names import infer_source
from maskloom.operators import assets as A
from maskloom.operators import filters as X
from maskloom.operators import layers as L
from maskloom.operators import masks as M
from maskloom.operators import quality as Q
from maskloom.operators import splits as S
from maskloom.plans.catalog import query


@query("SELECT doc_id, stem, view_key AS mask_key FROM v_assets a WHERE EXISTS (SELECT 1 FROM v_masks m WHERE m.view_key = a.view_key)")
def scan_flat(t):
    return A.scan_flat(t.v_assets.select("doc_id", "stem"), t.v_masks)


_TREE = """SELECT DISTINCT concat(view_key, '/image.png') AS path FROM v_assets WHERE mod(n, 3) = 0 UNION ALL SELECT DISTINCT concat(view_key, '/segmentation.png') FROM v_assets WHERE mod(n, 3) = 0 AND has_mask
UNION ALL SELECT DISTINCT concat(char_id, '/', angle, '/image.png') FROM v_assets WHERE mod(n, 3) = 1 UNION ALL SELECT DISTINCT concat(char_id, '/', angle, '/segmentation.png') FROM v_assets WHERE mod(n, 3) = 1
UNION ALL SELECT DISTINCT concat(char_id, '/', angle, '/depth.png') FROM v_assets WHERE mod(n, 3) = 1 AND has_joints UNION ALL SELECT DISTINCT concat(char_id, '/image.png') FROM v_assets WHERE mod(n, 6) = 1
UNION ALL SELECT DISTINCT concat(char_id, '/segmentation.png') FROM v_assets WHERE mod(n, 6) = 1"""


@query(f"""WITH p AS ({_TREE}), s AS (SELECT path, string_split(path, '/') AS q FROM p),
d AS (SELECT CASE WHEN len(q) = 2 THEN q[1] ELSE q[1] || '_' || q[2] END AS example_id, q[len(q)] AS file, path FROM s WHERE len(q) = 2 OR NOT EXISTS (SELECT 1 FROM s o WHERE len(o.q) = 2 AND o.q[2] = 'image.png' AND o.q[1] = s.q[1]))
SELECT example_id, max(path) FILTER (file = 'image.png') AS image_path, max(path) FILTER (file = 'segmentation.png') AS mask_path, bool_or(file = 'joints.json') AS has_joints, bool_or(file = 'weights.json') AS has_weights, bool_or(file = 'depth.png') AS has_depth,
 bool_or(file = 'normals.png') AS has_normals, bool_or(file = 'metadata.json') AS has_metadata FROM d GROUP BY 1 HAVING bool_or(file = 'image.png') AND bool_or(file = 'segmentation.png')""")
def scan_per_example(t):
    return A.scan_per_example(t.sql(_TREE))


_PAGES = "SELECT page_id, concat(replace(clean, '://', '/'), CASE mod(page_id, 5) WHEN 0 THEN '.png' WHEN 1 THEN '/bg 2/x.JPG' WHEN 2 THEN '.html' WHEN 3 THEN '/.cache/y.png' ELSE '/frame_12.webp' END) AS path FROM v_pages"


@query(f"""WITH p AS ({_PAGES}) SELECT page_id, path, TRY_CAST(nullif(regexp_extract(path, '(\\d+)[^/\\d]*$', 1), '') AS BIGINT) AS number FROM p
WHERE lower(regexp_extract(path, '(\\.[^./]+)$', 1)) IN ('.png', '.jpg', '.jpeg', '.webp') AND NOT regexp_matches(lower(path), '(^|/)bg') AND NOT regexp_matches(path, '(^|/)\\.[^/]')""")
def scan_images(t):
    return A.select_images(t.sql(_PAGES))


_SCENES = """SELECT concat(CASE WHEN mod(n, 3) = 0 THEN 'test' ELSE 'train' END, '/contour/', char_id, '/', CAST(mod(doc_id, 24) AS STRING), '.png') AS path FROM v_assets WHERE has_mask
UNION ALL SELECT concat(CASE WHEN mod(n, 3) = 0 THEN 'test' ELSE 'train' END, '/Frame_Anime/', char_id, CASE WHEN mod(n, 2) = 0 THEN '/original/' ELSE '/' END, CAST(mod(doc_id, 24) AS STRING), '.png') FROM v_assets WHERE has_joints
UNION ALL SELECT concat('train/Frame_Anime/', char_id, '/color_2/', CAST(mod(doc_id, 24) AS STRING), '.png') FROM v_assets WHERE has_source"""


@query(f"""WITH p AS ({_SCENES}), s AS (SELECT path, string_split(path, '/') AS q FROM p),
b AS (SELECT q[1] AS split, q[3] AS scene, regexp_replace(q[len(q)], '\\.[^.]+$', '') AS frame, path AS base_path FROM s WHERE q[2] = 'contour'),
c AS (SELECT q[1] AS split, q[3] AS scene, regexp_replace(q[len(q)], '\\.[^.]+$', '') AS frame, path AS companion_path, len(q) = 5 AS nested FROM s WHERE q[2] = 'Frame_Anime' AND (len(q) = 4 OR q[4] = 'original')),
k AS (SELECT * FROM c WHERE nested = (SELECT bool_or(nested) FROM c o WHERE o.split = c.split AND o.scene = c.scene))
SELECT b.split, b.scene, b.frame, base_path, companion_path FROM b JOIN k ON k.split = b.split AND k.scene = b.scene AND k.frame = b.frame""")
def scan_scene_frames(t):
    return A.scan_scene_frames(t.sql(_SCENES), "contour", "Frame_Anime")


_FILES = """SELECT 'masks' AS kind, view_key AS stem, concat('/m/', view_key, '.png') AS path FROM v_masks UNION ALL SELECT 'masks', concat(view_key, '_22'), concat('/m/', view_key, '_22.png') FROM v_masks WHERE prefix = 'mixamo'
UNION ALL SELECT 'depth', view_key, concat('/d/', view_key, '.png') FROM v_masks WHERE prefix <> 'kenney' UNION ALL SELECT 'joints', pose_key, concat('/j/', pose_key, '.json') FROM v_joint_files"""


@query(f"""WITH f AS ({_FILES}), i AS (SELECT stem, path, regexp_replace(stem, '_(painterly|sketch|pixel|unlit|flat|cel)$', '') AS base FROM v_assets)
SELECT i.stem AS example_id, i.path AS image_path, coalesce(a.path, b.path) AS mask_path, d.path AS depth_path, CAST(NULL AS VARCHAR) AS normals_path, j.path AS joints_path FROM i LEFT JOIN f a ON a.kind = 'masks' AND a.stem = i.base || '_22'
 LEFT JOIN f b ON b.kind = 'masks' AND b.stem = i.base LEFT JOIN f d ON d.kind = 'depth' AND d.stem = i.base LEFT JOIN f j ON j.kind = 'joints' AND j.stem = i.base""")
def restructure_layout(t):
    return A.restructure_layout(t.v_assets.select("stem", "path"), t.sql(_FILES))


_PAIR = """pa AS (SELECT stem AS item, 'mask' AS artifact, m.view_key IS NOT NULL AS passed FROM v_assets a LEFT JOIN v_masks m ON m.view_key = a.view_key
 UNION ALL SELECT p.pose_key, 'joints', j.pose_key IS NOT NULL FROM (SELECT DISTINCT pose_key FROM v_assets) p LEFT JOIN v_joint_files j ON j.pose_key = p.pose_key)"""


@query(f"WITH {_PAIR} SELECT * FROM pa")
def pair_artifacts(t):
    return A.pair_artifacts(t.v_assets.select("stem", "view_key", "pose_key"), t.v_masks, t.v_joint_files)


_SRC = "CASE WHEN s.source IS NOT NULL THEN s.source WHEN prefix = 'custom' THEN 'unknown' ELSE prefix END"
_IMG = f"im AS (SELECT doc_id, a.char_id, style, angle, {_SRC} AS source FROM v_assets a LEFT JOIN v_sources s ON s.char_id = a.char_id)"


def _images(t):
    return A.lookup_source(t.v_assets.select("doc_id", "char_id", "style", "angle"), t.v_sources)


@query(f"WITH {_IMG} SELECT * FROM im")
def lookup_source(t):
    return _images(t)


_CAT = """SELECT prefix AS source, 'images' AS category FROM v_assets UNION ALL SELECT prefix, 'masks' FROM v_masks UNION ALL SELECT split_part(char_id, '_', 1), 'joints' FROM v_joint_files UNION ALL SELECT split_part(char_id, '_', 1), 'sources' FROM v_sources"""


@query(f"WITH c AS ({_CAT}) SELECT coalesce(source, '*') AS source, coalesce(category, '*') AS category, count(*) AS n FROM c GROUP BY ROLLUP (source, category)")
def count_artifacts(t):
    return A.count_artifacts(t.sql(_CAT))


_BY = "cb AS (SELECT 'style' AS dimension, style AS value, count(*) AS n FROM im GROUP BY 2 UNION ALL SELECT 'angle', angle, count(*) FROM im GROUP BY 2 UNION ALL SELECT 'source', source, count(*) FROM im GROUP BY 2)"


@query(f"WITH {_IMG}, {_BY} SELECT * FROM cb")
def count_by(t):
    return A.count_by(_images(t))


@query("SELECT stem, width, height FROM v_assets WHERE width <> 512 OR height <> 512")
def check_resolution(t):
    return A.check_resolution(t.v_assets)


@query(f"""WITH {_PAIR}, n AS (SELECT example_id, class_id, sum(len) AS k FROM v_cells WHERE class_id > 0 GROUP BY 1, 2), u AS (SELECT e.example_id, count(n.class_id) AS c, coalesce(max(k / (SELECT sum(k) FROM n o WHERE o.example_id = e.example_id)), 0) AS top FROM (SELECT DISTINCT example_id FROM v_cells) e LEFT JOIN n ON n.example_id = e.example_id GROUP BY 1),
o AS (SELECT a.example_id, sum(a.len) AS alpha_px FROM v_alpha a GROUP BY 1), ov AS (SELECT m.example_id, sum(least(m.x0 + m.len, a.x0 + a.len) - greatest(m.x0, a.x0)) AS c FROM v_runs m JOIN v_alpha a ON a.example_id = m.example_id AND a.y = m.y AND a.x0 < m.x0 + m.len AND m.x0 < a.x0 + a.len GROUP BY 1),
jc AS (SELECT example_id, count(DISTINCT class_id) AS k, bool_or(visible AND (x < 0 OR x >= img_w OR y < 0 OR y >= img_h)) AS bad FROM v_joints GROUP BY 1),
c AS (SELECT 'resolution' AS chk, width = 512 AND height = 512 AS passed FROM v_assets UNION ALL SELECT 'file_pairing', passed FROM pa UNION ALL SELECT 'mask_uniqueness', c <> 1 FROM u UNION ALL SELECT 'region_distribution', top <= 0.6 FROM u
 UNION ALL SELECT 'mask_completeness', alpha_px = coalesce(c, 0) FROM o LEFT JOIN ov ON ov.example_id = o.example_id UNION ALL SELECT 'joint_count', k = 19 FROM jc UNION ALL SELECT 'joint_bounds', NOT bad FROM jc)
SELECT chk AS "check", count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed FROM c GROUP BY 1""")
def validate_dataset(t):
    images, joints = t.v_assets, t.v_joints
    masks = Q.mask_checks(t.v_cells)
    pairs = A.pair_artifacts(images.select("stem", "view_key", "pose_key"), t.v_masks, t.v_joint_files)
    bounds = joints.select("example_id").distinct().join(Q.joint_bounds_check(joints).select("example_id", F.lit(True).alias("_bad")).distinct(), "example_id", "left")
    return A.check_summary(
        A.as_check(images, "resolution", "stem", (F.col("width") == 512) & (F.col("height") == 512)),
        A.as_check(pairs, "file_pairing", "item", "passed"),
        A.as_check(masks, "mask_uniqueness", "example_id", "unique_ok"), A.as_check(masks, "region_distribution", "example_id", "dominance_ok"),
        A.as_check(L.mask_completeness(t.v_runs, t.v_alpha), "mask_completeness", "example_id", "passed"),
        A.as_check(Q.joint_set_check(joints, dims.JOINT_NAMES), "joint_count", "example_id", "passed"),
        A.as_check(bounds, "joint_bounds", "example_id", F.col("_bad").isNull()),
    )


_RES = "SELECT char_id, CASE WHEN max(size) > 15000 THEN 'timeout' END AS error, CAST(sum(CASE WHEN width <> 512 THEN 1 ELSE 0 END) AS BIGINT) AS poses_failed FROM v_assets GROUP BY char_id"
_INFO = f"rs AS ({_RES}), qi AS (SELECT 'failed' AS kind, char_id, CAST(NULL AS BIGINT) AS poses_failed FROM rs WHERE error IS NOT NULL UNION ALL SELECT 'warning', char_id, poses_failed FROM rs WHERE error IS NULL AND poses_failed > 0 UNION ALL SELECT DISTINCT 'unmapped_bones', char_id, CAST(NULL AS BIGINT) FROM v_sources WHERE unmapped)"


@query(f"WITH {_INFO} SELECT * FROM qi")
def quality_info(t):
    return A.quality_info(t.sql(_RES), t.v_sources)


@query(f"""WITH {_INFO}, {_IMG}, {_BY}, c AS ({_CAT}), n AS (SELECT class_id, sum(len) AS k FROM v_cells WHERE class_id > 0 GROUP BY 1)
SELECT 'files' AS section, coalesce(source, '*') || '/' || coalesce(category, '*') AS "key", CAST(count(*) AS DOUBLE) AS value FROM c GROUP BY ROLLUP (source, category)
UNION ALL SELECT 'images', dimension || '=' || value, CAST(n AS DOUBLE) FROM cb UNION ALL SELECT 'regions', class_name, round_even(coalesce(k, 0) / (SELECT sum(k) FROM n), 4) FROM v_classes v LEFT JOIN n ON n.class_id = v.class_id WHERE v.class_id > 0
UNION ALL SELECT 'quality', kind, CAST(count(*) AS DOUBLE) FROM qi GROUP BY kind""")
def dataset_manifest(t):
    return A.dataset_manifest(A.count_artifacts(t.sql(_CAT)), A.count_by(_images(t)), M.class_distribution(t.v_cells), A.quality_info(t.sql(_RES), t.v_sources))


_SPECS = [
    A.DatasetSpec("mixamo", ("**/images/*.png", "**/images/*_soft_cel.jpg"), 3, (".png",)), A.DatasetSpec("kenney", ("**/ortho/*.png", "images/*"), 100000000),
    A.DatasetSpec("custom", ("**/*.png", "**/*.jpg")), A.DatasetSpec("absent", ("**/*.png",)),
]


@query(f"""WITH f AS (SELECT prefix AS dataset, regexp_replace(path, '^/data/[a-z]+/', '') AS path FROM v_assets), s(dataset, ord, pattern, rx) AS (VALUES {", ".join(f"('{s.name}', {j}, '{p}', '{A.glob_regex(p)}')" for s in _SPECS for j, p in enumerate(s.required))}),
d(dataset, min_files) AS (VALUES {", ".join(f"('{s.name}', {s.min_files})" for s in _SPECS)}), c AS (SELECT dataset, count(*) AS n, count(*) FILTER (path NOT LIKE '%.png') AS odd FROM f GROUP BY 1),
m AS (SELECT dataset, 'no files matching ''' || pattern || '''' AS t, ord FROM s WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.dataset = s.dataset AND regexp_matches(f.path, s.rx))
  UNION ALL SELECT d.dataset, 'fewer than ' || min_files || ' files', 99 FROM d LEFT JOIN c ON c.dataset = d.dataset WHERE min_files > 0 AND coalesce(n, 0) < min_files)
SELECT d.dataset, n IS NOT NULL AS present, coalesce(n, 0) AS file_count, coalesce((SELECT string_agg(t, '|' ORDER BY ord) FROM m WHERE m.dataset = d.dataset), '') AS missing, CASE WHEN d.dataset = 'mixamo' THEN coalesce(odd, 0) ELSE 0 END AS wrong_format FROM d LEFT JOIN c ON c.dataset = d.dataset""")
def verify_spec(t):
    paths = t.v_assets.select(F.col("prefix").alias("dataset"), F.regexp_replace("path", "^/data/[a-z]+/", "").alias("path"))
    return A.verify_spec(paths, _SPECS).withColumn("missing", F.array_join("missing", "|"))


_META = "SELECT DISTINCT view_key AS example_id, char_id, pose_key, prefix FROM v_assets"


@query(f"""WITH e AS ({_META}), f AS (SELECT e.*, m.view_key IS NOT NULL AS a, j.pose_key IS NOT NULL AS b, s.char_id IS NOT NULL AS c FROM e LEFT JOIN v_masks m ON m.view_key = e.example_id LEFT JOIN v_joint_files j ON j.pose_key = e.pose_key LEFT JOIN v_sources s ON s.char_id = e.char_id)
SELECT example_id, char_id, pose_key, prefix, CASE WHEN prefix = 'custom' THEN 'unknown' ELSE prefix END AS dataset_source, 512 AS resolution, a AS has_segmentation, b AS has_joints, c AS has_source,
 array_to_string(list_filter([CASE WHEN NOT a THEN 'segmentation' END, CASE WHEN NOT b THEN 'joints' END, CASE WHEN NOT c THEN 'source' END], lambda x: x IS NOT NULL), '|') AS missing_annotations FROM f""")
def build_example_metadata(t):
    masks = t.v_masks.withColumnRenamed("view_key", "example_id")
    companions = {"segmentation": (masks, "example_id"), "joints": (t.v_joint_files, "pose_key"), "source": (t.v_sources, "char_id")}
    out = A.build_example_metadata(t.sql(_META), companions, infer_source(F.col("char_id")))
    return out.select("example_id", "char_id", "pose_key", "prefix", "dataset_source", "resolution", "has_segmentation", "has_joints", "has_source", F.array_join("missing_annotations", "|").alias("missing_annotations"))


# --- joins ---
_ANN = "SELECT DISTINCT view_key AS stem FROM v_assets"
_EXTF = "SELECT view_key AS stem, CASE mod(doc_id, 3) WHEN 0 THEN '.png' WHEN 1 THEN '.gif' ELSE '.jpg' END AS ext, concat('/', CAST(doc_id AS STRING), '/', view_key) AS path FROM v_assets WHERE has_mask"


@query(f"WITH a AS ({_ANN}), f AS ({_EXTF}), b AS (SELECT stem, path FROM f WHERE ext <> '.gif' QUALIFY row_number() OVER (PARTITION BY stem ORDER BY CASE ext WHEN '.jpg' THEN 0 ELSE 1 END, path) = 1) SELECT a.stem, b.path FROM a LEFT JOIN b ON b.stem = a.stem")
def prefer_extension_match(t):
    return A.prefer_extension_match(t.sql(_ANN), t.sql(_EXTF))


_RIG = "SELECT l_suppkey * 100 + l_linenumber AS rigged, CAST(max(l_quantity) * 2 - min(l_quantity) AS INT) AS vertices FROM lineitem GROUP BY 1"


@query(f"""WITH r AS ({_RIG}), o AS (SELECT p_size AS vertices, min(path) AS path, count(*) AS k FROM (SELECT p_size, concat(p_brand, '/', p_name, CAST(p_partkey AS STRING)) AS path FROM part) GROUP BY 1)
SELECT r.vertices, rigged, path, CASE WHEN k IS NULL THEN 'unmatched' WHEN k > 1 THEN 'ambiguous' ELSE 'unique' END AS match FROM r LEFT JOIN o ON o.vertices = r.vertices""")
def fingerprint_match(t):
    originals = t.sql("SELECT p_size AS vertices, concat(p_brand, '/', p_name, CAST(p_partkey AS STRING)) AS path FROM part")
    return A.fingerprint_match(t.sql(_RIG), originals)


_ITEMS = "SELECT DISTINCT CASE WHEN mod(p_partkey, 3) = 0 THEN p_name WHEN mod(p_partkey, 3) = 1 THEN concat('x', p_name) ELSE substring(p_name, 3, 9) END AS char_id FROM part"
_MODELS = "SELECT concat('/models/', p_brand, '/', p_type, ' ', p_name, '_', CAST(p_partkey AS STRING)) AS path, concat(p_type, ' ', p_name, '_', CAST(p_partkey AS STRING)) AS stem FROM part"


@query(f"WITH i AS ({_ITEMS}), m AS ({_MODELS}) SELECT i.char_id, (SELECT min(path) FROM m WHERE contains(m.stem, i.char_id)) AS path FROM i")
def contains_match(t):
    return A.contains_match(t.sql(_ITEMS), t.sql(_MODELS))


@query("""WITH g AS (SELECT pose_key, min(path) FILTER (angle = 'front') AS front, min(path) FILTER (angle = 'three_quarter') AS three_quarter, min(path) FILTER (angle = 'back') AS back FROM v_assets GROUP BY 1)
SELECT *, row_number() OVER (ORDER BY pose_key) - 1 AS pair_index FROM g WHERE front IS NOT NULL AND three_quarter IS NOT NULL AND back IS NOT NULL""")
def complete_view_sets(t):
    return A.complete_view_sets(t.v_assets, ["front", "three_quarter", "back"])


_VW = "SELECT pose_key AS char_id, angle, path FROM v_assets"


@query(f"""WITH w AS ({_VW}), v AS (SELECT char_id, angle, min(path) AS path, count(*) OVER (PARTITION BY char_id) AS n FROM w GROUP BY 1, 2)
SELECT t.char_id, a.path AS source_a, b.path AS source_b, t.path AS target FROM v t JOIN v a ON a.char_id = t.char_id AND a.angle <> t.angle JOIN v b ON b.char_id = t.char_id AND b.angle <> t.angle AND b.angle > a.angle WHERE t.n >= 3
UNION ALL SELECT a.char_id, a.path, b.path, b.path FROM v a JOIN v b ON b.char_id = a.char_id AND b.angle <> a.angle WHERE a.n = 2""")
def view_triplets(t):
    return A.view_triplets(t.sql(_VW))


# the tree relation, and copies of its rigs whose root hangs below its own child
_RIGS = """SELECT rig_id, bone, parent, x, y, rotation, sx, sy FROM v_tree
UNION ALL SELECT rig_id + 1000000, bone, CASE WHEN bone = 1 THEN 2 ELSE parent END, x, y, rotation, sx, sy FROM v_tree WHERE rig_id IN (SELECT rig_id FROM v_tree WHERE bone = 2)"""
_WORLD = """w AS (SELECT rig_id, bone, x AS wx, y AS wy, rotation, sx, sy FROM rg c WHERE NOT EXISTS (SELECT 1 FROM rg p WHERE p.rig_id = c.rig_id AND p.bone = c.parent)
 UNION ALL SELECT c.rig_id, c.bone, w.wx + c.x * w.sx * cos(radians(w.rotation)) - c.y * w.sy * sin(radians(w.rotation)), w.wy + c.x * w.sx * sin(radians(w.rotation)) + c.y * w.sy * cos(radians(w.rotation)), w.rotation + c.rotation, w.sx * c.sx, w.sy * c.sy
 FROM rg c JOIN w ON w.rig_id = c.rig_id AND w.bone = c.parent),
cy AS (SELECT rig_id, bone FROM rg EXCEPT SELECT rig_id, bone FROM w)"""


def _rigs(t):
    return t.sql(_RIGS).withColumns({c: F.col(c).cast("double") for c in ("sx", "sy")})


@query(f"WITH RECURSIVE rg AS MATERIALIZED ({_RIGS}), {_WORLD} SELECT rig_id, bone, round(wx, 5) AS wx, round(wy, 5) AS wy, rotation, round(sx, 6) AS sx, round(sy, 6) AS sy FROM w WHERE rig_id NOT IN (SELECT rig_id FROM cy)")
def world_transform(t):
    out = A.world_transform(_rigs(t))
    return out.withColumns({"wx": F.round("wx", 5), "wy": F.round("wy", 5), "sx": F.round("sx", 6), "sy": F.round("sy", 6)})


@query(f"WITH RECURSIVE rg AS MATERIALIZED ({_RIGS}), {_WORLD} SELECT * FROM cy")
def cyclic_bones(t):
    return A.cyclic_bones(_rigs(t))


# --- filters ---
_ITEM = """SELECT doc_id, text AS prompt, CAST(300 + mod(n_chars, 500) AS INT) AS width, CAST(CASE WHEN mod(doc_id, 31) = 0 THEN 0 ELSE 400 + mod(doc_id, 500) END AS INT) AS height, CASE WHEN mod(doc_id, 19) = 4 THEN 'video' ELSE 'image' END AS type FROM documents"""
_KW = {"branded": ["copyright", "licensed under", "©"], "personal": ["@", "password"]}
_REJ = f"""it AS ({_ITEM}), jr AS (SELECT doc_id, CASE {" ".join("WHEN " + " OR ".join(f"contains(lower(prompt), '{w}')" for w in ws) + f" THEN '{k}'" for k, ws in _KW.items())}
 WHEN width > 0 AND height > 0 AND height / width < 11e-1 THEN 'landscape' WHEN type <> 'image' THEN 'not_image' END AS reason FROM it)"""


@query(f"WITH {_REJ} SELECT doc_id, reason FROM jr")
def first_reject_reason(t):
    return X.first_reject_reason(t.sql(_ITEM), _KW).select("doc_id", "reason")


@query(f"WITH {_REJ} SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM jr GROUP BY 1")
def reject_reason_counts(t):
    return X.reason_counts(X.first_reject_reason(t.sql(_ITEM), _KW))


_POST = """SELECT doc_id, CAST(mod(n_chars, 100) AS INT) AS score, CASE lang WHEN 'en' THEN 'g' WHEN 'fr' THEN 's' ELSE 'q' END AS rating, CASE WHEN mod(doc_id, 9) = 2 THEN 'mp4' ELSE 'png' END AS file_ext, lower(text) AS body,
 CAST(400 + mod(n_chars * 7, 900) AS INT) AS width, CAST(500 + mod(doc_id * 13, 900) AS INT) AS height FROM documents"""


@query(f"""WITH p AS (SELECT *, string_split_regex(body, '[ \\n]+') AS tags FROM ({_POST})) SELECT doc_id, score, rating, width, height FROM p WHERE score >= 30 AND rating IN ('g', 's') AND file_ext IN ('png', 'jpg', 'jpeg', 'webp')
 AND (list_contains(tags, 'the') OR list_contains(tags, 'la')) AND NOT list_has_any(tags, ['wh', 'was', 'il']) AND least(width, height) >= 512 AND greatest(width, height) / greatest(least(width, height), 1) <= 2""")
def post_filter(t):
    posts = t.sql(_POST).withColumn("tags", F.split("body", "[ \\n]+"))
    posts = posts.withColumn("tags", F.transform("tags", lambda x: F.when(x == "la", "the").otherwise(x)))
    return X.post_filter(posts, "the", ["wh", "was", "il"]).select("doc_id", "score", "rating", "width", "height")


_LIC = "SELECT doc_id, CASE mod(doc_id, 7) WHEN 0 THEN 'MIT' WHEN 1 THEN 'GPL-3.0' WHEN 2 THEN NULL WHEN 3 THEN 'NOASSERTION' WHEN 4 THEN 'WTFPL' WHEN 5 THEN 'CC-BY-4.0' ELSE 'CC-BY-NC-4.0' END AS license FROM documents"
_STATE = f"st AS (SELECT doc_id, license, CASE WHEN license IN ('GPL-3.0', 'CC-BY-NC-4.0') THEN 'rejected' WHEN license IN ('MIT', 'CC-BY-4.0') THEN 'accepted' ELSE 'unknown' END AS license_state FROM ({_LIC}))"


@query(f"WITH {_STATE} SELECT * FROM st WHERE license_state <> 'rejected'")
def license_gate(t):
    return X.license_gate(t.sql(_LIC))


@query(f"WITH {_STATE} SELECT * FROM st WHERE license_state = 'accepted'")
def license_gate_strict(t):
    return X.license_gate(t.sql(_LIC), strict=True)


_REPO = "SELECT concat(replace(directory, '://', '/'), CASE mod(page_id, 5) WHEN 0 THEN '/a.moc3' WHEN 1 THEN '/textures/x.PNG' WHEN 2 THEN '/sub/b.model3.json' WHEN 3 THEN '/other/c.png' ELSE '/d.txt' END) AS path FROM v_pages"


@query(f"""WITH p AS ({_REPO}), m AS (SELECT DISTINCT regexp_replace(path, '/[^/]*$', '') AS dir FROM p WHERE lower(path) LIKE '%.moc3' OR lower(path) LIKE '%.model3.json'), g AS (SELECT DISTINCT regexp_replace(path, '/[^/]*$', '') AS dir FROM p WHERE lower(path) LIKE '%.png')
SELECT dir FROM m WHERE dir IN (SELECT dir FROM g) OR dir || '/textures' IN (SELECT dir FROM g) OR dir || '/parts' IN (SELECT dir FROM g) OR dir || '/images' IN (SELECT dir FROM g) OR (contains(dir, '/') AND regexp_replace(dir, '/[^/]*$', '') IN (SELECT dir FROM g))""")
def dirs_with_companion(t):
    return X.dirs_with_companion(t.sql(_REPO))


@query("SELECT doc_id FROM documents WHERE NOT list_has_any([upper(lang), source], ['x']) AND lower(lang) NOT IN ('fr', 'es') AND lower(source) <> 'src3'")
def tag_overlap_exclude(t):
    models = t.documents.select("doc_id", F.array(F.upper("lang"), F.initcap("source")).alias("tags"))
    return X.tag_overlap_exclude(models, ["fr", "es", "src3"]).select("doc_id")


_STAT = "SELECT doc_id AS example_id, CASE WHEN toxic = 1 THEN 'rejected' WHEN quality = 1 THEN 'reviewed' ELSE 'needs_review' END AS status FROM labels"


@query(f"WITH s AS ({_STAT}) SELECT doc_id AS example_id, source AS dataset FROM documents WHERE doc_id IN (SELECT example_id FROM s WHERE status = 'reviewed')")
def status_filter(t):
    return X.status_filter(t.documents.select(F.col("doc_id").alias("example_id"), F.col("source").alias("dataset")), t.sql(_STAT), "reviewed")


@query("SELECT doc_id AS example_id, source AS dataset FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def drop_rejected(t):
    docs = t.documents.select(F.col("doc_id").alias("example_id"), F.col("source").alias("dataset"))
    return X.drop_rejected(docs, docs.join(t.labels.where("toxic = 1").select(F.col("doc_id").alias("example_id")), "example_id"))


@query(f"WITH s AS ({_STAT}) SELECT count(*) AS total, count(*) FILTER (status = 'reviewed') AS reviewed, count(*) FILTER (status = 'rejected') AS rejected, count(*) FILTER (status = 'needs_review') AS needs_review FROM s")
def status_counts(t):
    return X.status_counts(t.sql(_STAT))


_SCORE = "SELECT doc_id AS example_id, CAST(mod(n_chars, 1000) AS DOUBLE) / 1000 AS score FROM documents"


@query(f"WITH s AS ({_SCORE}) SELECT count(*) AS total, round_even(avg(score), 4) AS mean, round_even(quantile_cont(score, 0.5), 4) AS median, min(score) AS min, max(score) AS max, count(*) FILTER (score >= 0.5) AS good, count(*) FILTER (score < 0.5 AND score >= 0.3) AS review, count(*) FILTER (score < 0.3) AS likely_bad FROM s")
def confidence_report(t):
    return X.confidence_summary(t.sql(_SCORE))


@query(f"WITH s AS ({_SCORE}) SELECT example_id, score, CASE WHEN score < 0.3 THEN 'very_low' ELSE 'low' END AS band FROM s WHERE score < 0.5")
def low_confidence(t):
    return X.low_confidence(t.sql(_SCORE), "example_id")


@query("SELECT char_id, count(*) AS bad FROM v_assets WHERE size < 800 GROUP BY 1")
def bad_by_character(t):
    from maskloom.functions.names import parse_stem

    bad = t.v_assets.where("size < 800").select("stem").withColumns(parse_stem("stem"))
    return bad.groupBy(F.col("p_char").alias("char_id")).agg(F.count(F.lit(1)).alias("bad"))


# --- sampling and work lists ---
@query("SELECT doc_id, stem FROM v_assets ORDER BY stem LIMIT 60")
def capped_sample(t):
    return A.capped_sample(t.v_assets.select("doc_id", "stem"), "stem", 60)


@query("SELECT doc_id, stem FROM v_assets ORDER BY md5('9:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 60")
def seeded_sample(t):
    return A.capped_sample(t.v_assets.select("doc_id", "stem"), "doc_id", 60, seed=9)


@query("""WITH r AS (SELECT doc_id, stem, row_number() OVER (ORDER BY stem) - 1 AS r, count(*) OVER () AS n FROM v_assets)
SELECT doc_id, stem FROM r WHERE r IN (SELECT CAST(floor(i * (n - 1) / 76) AS BIGINT) FROM (SELECT unnest(range(77)) AS i), (SELECT count(*) AS n FROM v_assets))""")
def even_sample(t):
    return A.even_sample(t.v_assets.select("doc_id", "stem"), "stem", 77)


@query("SELECT char_id, flipped, scale FROM (SELECT DISTINCT char_id FROM v_assets), (VALUES (FALSE, 1.0::DOUBLE), (FALSE, 0.85), (FALSE, 1.15), (TRUE, 1.0), (TRUE, 0.85), (TRUE, 1.15)) AS g(flipped, scale)")
def augmentation_grid(t):
    return A.augmentation_grid(t.v_assets.select("char_id").distinct())


@query("""SELECT c.char_id, CAST(p AS INT) AS pose, a AS angle, s AS style FROM (SELECT DISTINCT char_id FROM v_assets) c, (SELECT unnest(range(3)) AS p), (SELECT unnest(['front', 'side', 'back']) AS a), (SELECT unnest(['flat', 'cel', 'pixel']) AS s)
WHERE NOT EXISTS (SELECT 1 FROM v_assets v WHERE v.char_id = c.char_id AND v.pose = p AND v.angle = a AND v.style = s)""")
def render_plan(t):
    assets = t.v_assets
    return A.render_plan(assets.select("char_id").distinct(), assets, 3, ["front", "side", "back"], ["flat", "cel", "pixel"])


_AXES = {"style": (dims.STYLES, 1), "region": (dims.JOINT_NAMES, 7), "angle": (list(dims.ANGLES), 3)}


def _pick(values, expr):
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][({expr}) % {len(values)} + 1]"


@query(f"SELECT printf('SC-%03d', p_partkey + 1) AS prompt_id, {', '.join(f'{_pick(v, f'p_partkey * {s}')} AS {n}' for n, (v, s) in _AXES.items())} FROM part")
def prompt_rotation(t):
    return A.prompt_rotation(t.part, "p_partkey", _AXES)


_GAX = {"style": dims.STYLES, "region": dims.JOINT_NAMES, "angle": list(dims.ANGLES)}
_TOTAL = len(dims.STYLES) * 19 * len(dims.ANGLES)


@query(f"""SELECT p_partkey, {_pick(dims.STYLES, 'z')} AS style, {_pick(dims.JOINT_NAMES, 'z // 10')} AS region, {_pick(list(dims.ANGLES), 'z // 190')} AS angle, p_partkey // {_TOTAL} AS cycle
FROM (SELECT p_partkey, (p_partkey * 3641 + 42) % {_TOTAL} AS z FROM part)""")
def prompt_grid(t):
    return A.prompt_grid(t.part, "p_partkey", _GAX)


_REJX = "SELECT batch AS dataset, stem AS example_id FROM v_assets WHERE size < 700"
_FRZ = "SELECT char_id, CASE WHEN mod(n, 5) = 0 THEN 'val' WHEN mod(n, 7) = 0 THEN 'test' ELSE 'train' END AS split FROM v_assets GROUP BY char_id, n"


_DEPTH = "SELECT DISTINCT view_key FROM v_assets WHERE has_source AND width = 512"
_NORMALS = "SELECT DISTINCT view_key FROM v_assets WHERE has_joints"
_TRAIN = f"""z AS ({_FRZ}), tr AS (SELECT batch AS dataset, stem AS example_id, a.char_id, view_key AS mask_key, CASE batch WHEN 'src1' THEN 2.0 WHEN 'src2' THEN 0.5 ELSE 1.0 END::DOUBLE AS dataset_weight,
 view_key IN ({_DEPTH}) AS has_depth, view_key IN ({_NORMALS}) AS has_normals FROM v_assets a
WHERE view_key IN (SELECT view_key FROM v_masks) AND (SELECT split FROM z WHERE z.char_id = a.char_id) = 'train' AND NOT (size < 700))"""


def _training_set(t):
    images = t.v_assets.select(F.col("batch").alias("dataset"), F.col("stem").alias("example_id"), "stem", "char_id")
    splits = S.frozen_split(images.select("char_id", F.lit("all").alias("source")).distinct(), t.sql(_FRZ))
    return A.assemble_training_set(images, t.v_masks, splits, t.sql(_REJX), {"src1": 2.0, "src2": 0.5}, companions={"depth": t.sql(_DEPTH), "normals": t.sql(_NORMALS)})


@query(f"WITH {_TRAIN} SELECT * FROM tr")
def assemble_training_set(t):
    return _training_set(t)


@query(f"WITH {_TRAIN} SELECT dataset, count(*) AS examples, count(*) FILTER (has_depth) AS with_depth, count(*) FILTER (has_normals) AS with_normals FROM tr GROUP BY 1")
def training_counts(t):
    return A.training_counts(_training_set(t))

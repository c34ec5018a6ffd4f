"""Path and artifact relations: pairing, layouts, specs, work lists."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom import dims
from maskloom.functions.names import CHARACTER_PATTERNS, first_reason, infer_source, parse_stem, strip_style  # noqa: F401
from maskloom.functions.ranking import rank_by_hash, rank_sorted
from maskloom.session import cut

# --- layouts ---


def scan_flat(images: DataFrame, masks: DataFrame) -> DataFrame:
    """Images whose mask exists once the style suffix is removed."""
    keyed = images.withColumn("mask_key", strip_style(F.col("stem")))
    return keyed.join(masks.select(F.col("view_key").alias("mask_key")), "mask_key", "left_semi")


# Artifact file names of the per-example layout.
ARTIFACTS = {
    "image": "image.png", "mask": "segmentation.png", "joints": "joints.json", "weights": "weights.json",
    "depth": "depth.png", "normals": "normals.png", "metadata": "metadata.json",
}


def scan_per_example(paths: DataFrame, root: str = "") -> DataFrame:
    """``{id}/image.png`` or ``{id}/{view}/image.png`` to one row per example with artifact flags.

    An example needs its image and its mask; views count only where ``{id}`` has no image itself.
    """
    rel = F.regexp_replace("path", "^" + re.escape(root.rstrip("/")) + "/", "") if root else F.col("path")
    parts = F.split(rel, "/")
    depth = F.size(parts)
    example = F.when(depth == 2, parts[0]).when(depth == 3, F.concat_ws("_", parts[0], parts[1]))
    df = paths.select(parts[0].alias("_top"), (depth == 3).alias("_nested"), example.alias("example_id"), F.element_at(parts, -1).alias("file"), "path")
    df = df.where("example_id IS NOT NULL")
    direct = df.where(~F.col("_nested") & (F.col("file") == ARTIFACTS["image"])).select("_top").distinct()
    df = df.where(~F.col("_nested")).unionByName(df.where("_nested").join(direct, "_top", "left_anti").select(*df.columns))
    has = {k: F.max(F.when(F.col("file") == f, F.col("path"))) for k, f in ARTIFACTS.items()}
    out = df.groupBy("example_id").agg(has["image"].alias("image_path"), has["mask"].alias("mask_path"), *[
        has[k].isNotNull().alias(f"has_{k}") for k in ARTIFACTS if k not in ("image", "mask")
    ])
    return out.where("image_path IS NOT NULL AND mask_path IS NOT NULL")


IMAGE_EXTENSIONS = (".png", ".jpg", ".jpeg", ".webp")


def select_images(paths: DataFrame, extensions: Sequence[str] = IMAGE_EXTENSIONS, exclude_prefix: str = "bg") -> DataFrame:
    """Image files by extension, outside excluded and hidden directories, with both sort keys."""
    ext = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    bad = F.exists(F.split("path", "/"), lambda d: F.lower(d).startswith(exclude_prefix) | (d.startswith(".") & (F.length(d) > 1)))
    number = F.regexp_extract("path", r"(\d+)[^/\d]*$", 1).try_cast("long")
    return paths.where(ext.isin(list(extensions)) & ~bad).withColumn("number", number)


def scan_scene_frames(paths: DataFrame, base: str, companion: str, variant: str = "original") -> DataFrame:
    """(split, scene, frame) of frames whose scene has both folders; the variant folder is preferred.

    Paths are ``{split}/{folder}/{scene}/[{variant}/]{frame}.ext``.
    """
    p = F.split("path", "/")
    df = paths.select(
        p[0].alias("split"), p[1].alias("folder"), p[2].alias("scene"), (F.size(p) == 5).alias("_nested"),
        F.when(F.size(p) == 5, p[3]).alias("_variant"), F.regexp_replace(F.element_at(p, -1), r"\.[^.]+$", "").alias("frame"), "path",
    )
    key = ["split", "scene"]
    left = df.where(F.col("folder") == base).select(*key, "frame", F.col("path").alias("base_path"))
    other = df.where((F.col("folder") == companion) & (~F.col("_nested") | (F.col("_variant") == variant)))
    pick = other.groupBy(*key).agg(F.max("_nested").alias("_use"))
    other = other.join(pick, key).where(F.col("_nested") == F.col("_use")).select(*key, "frame", F.col("path").alias("companion_path"))
    scenes = pick.select(*key)
    out = left.join(scenes, key, "left_semi").join(other, [*key, "frame"])
    return out


LAYOUT_STYLES = ("flat", "cel", "sketch", "pixel", "painterly", "unlit")


def restructure_layout(images: DataFrame, files: DataFrame) -> DataFrame:
    """Flat layout to a per-example manifest: first existing mask candidate, optional companions.

    ``files(kind, stem, path)`` with kinds masks, depth, normals, joints; nothing is moved.
    """
    base = images.withColumn("base", strip_style(F.col("stem"), LAYOUT_STYLES))
    masks = files.where("kind = 'masks'")
    wide = F.regexp_replace("stem", "_22$", "")
    cand = F.array_compact(F.array(
        F.struct(F.col("stem").alias("base"), F.lit(1).alias("rank")), F.when(F.col("stem").endswith("_22"), F.struct(wide.alias("base"), F.lit(0).alias("rank")))
    ))
    first = masks.select(F.explode(cand).alias("_c"), "path").groupBy(F.col("_c.base").alias("base")).agg(F.min_by("path", F.struct("_c.rank", "path")).alias("mask_path"))
    out = base.join(first, "base", "left")
    for kind in ("depth", "normals", "joints"):
        one = files.where(F.col("kind") == kind).groupBy(F.col("stem").alias("base")).agg(F.min("path").alias(f"{kind}_path"))
        out = out.join(one, "base", "left")
    return out.select(F.col("stem").alias("example_id"), F.col("path").alias("image_path"), "mask_path", "depth_path", "normals_path", "joints_path")


# --- pairing ---


def pair_artifacts(images: DataFrame, masks: DataFrame, joints: DataFrame) -> DataFrame:
    """One row per image for its mask, one per pose for its joints."""
    m = images.join(masks.select("view_key", F.lit(True).alias("_m")), "view_key", "left")
    by_image = m.select(F.col("stem").alias("item"), F.lit("mask").alias("artifact"), F.coalesce("_m", F.lit(False)).alias("passed"))
    poses = images.select("pose_key").distinct()
    j = poses.join(joints.select("pose_key", F.lit(True).alias("_j")), "pose_key", "left")
    return by_image.unionByName(j.select(F.col("pose_key").alias("item"), F.lit("joints").alias("artifact"), F.coalesce("_j", F.lit(False)).alias("passed")))


def lookup_source(images: DataFrame, sources: DataFrame) -> DataFrame:
    """Source from the character's metadata, else from the id prefix."""
    s = sources.select("char_id", F.nullif("source", F.lit("")).alias("_s"))
    return images.join(s, "char_id", "left").withColumn("source", F.coalesce("_s", infer_source(F.col("char_id")))).drop("_s")


def prefer_extension_match(annotations: DataFrame, files: DataFrame, extensions: Sequence[str] = (".jpg", ".png", ".jpeg", ".webp")) -> DataFrame:
    """File of an annotation id, by extension preference."""
    rank = F.coalesce(*[F.when(F.col("ext") == e, F.lit(i)) for i, e in enumerate(extensions)])
    f = files.where(F.col("ext").isin(list(extensions))).groupBy("stem").agg(F.min_by("path", F.struct(rank.alias("r"), F.col("path").alias("p"))).alias("path"))
    return annotations.join(f, "stem", "left")


def fingerprint_match(rigged: DataFrame, originals: DataFrame, key: str = "vertices") -> DataFrame:
    """Match by equal vertex count: unique, ambiguous (first path), unmatched."""
    o = originals.groupBy(key).agg(F.min("path").alias("path"), F.count(F.lit(1)).alias("_n"))
    out = rigged.join(o, key, "left")
    state = F.when(F.col("_n").isNull(), "unmatched").when(F.col("_n") > 1, "ambiguous").otherwise("unique")
    return out.withColumn("match", state).drop("_n")


def _grams(text: Column, n: Column | int) -> Column:
    """The different pieces of ``n`` characters; none if the text is shorter."""
    size = F.length(text)
    n = F.lit(n) if isinstance(n, int) else n
    return F.when(size >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.substring(text, i, n)))).otherwise(F.array().cast("array<string>"))


#: ids that may travel to every task of a lookup
FEW_IDS = 50_000


def contains_match(items: DataFrame, models: DataFrame, item: str = "char_id", q: int = 4) -> DataFrame:
    """First model (path order) whose stem contains the item's id; an empty id matches nothing.

    An inverted index of q-grams: every stem is listed under its different grams, an id is looked up under the one of its grams that fewest stems
    have, and what is found is compared in full. A gram that no stem has settles an id without a lookup. Ids shorter than ``q`` are grams of their own length.
    """
    ids = items.select(item).where(F.length(item) > 0).distinct()
    length = F.least(F.length(item), F.lit(q))
    lengths = sorted(r[0] for r in ids.select(length).distinct().collect())  # at most q rows
    if not lengths:
        return items.withColumn("path", F.lit(None).cast("string"))
    tasks = int(models.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a small file is one task otherwise, however many grams it makes
    listed = models.select("path", "stem").repartition(tasks, "path").select("path", "stem", F.explode(F.flatten(F.array(*[_grams(F.col("stem"), n) for n in lengths]))).alias("_gram"))
    counts = listed.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    # hints: an explode keeps the size estimate of its source, so the planner may broadcast the grams' counts, and the whole index if the ids have no estimate
    own = ids.select(item, F.explode(_grams(F.col(item), length)).alias("_gram")).join(counts.hint("merge"), "_gram", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    rarest = cut(own.groupBy(item).agg(F.min(F.struct("_n", "_gram")).alias("_r")).where("_r._n > 0").select(item, F.col("_r._gram").alias("_gram")))
    few = rarest.count() <= FEW_IDS
    found = (F.broadcast(rarest) if few else rarest.hint("merge")).join(listed, "_gram").where(F.contains("stem", F.col(item)))
    best = found.groupBy(item).agg(F.min("path").alias("path"))
    return items.join(best, item, "left")


def complete_view_sets(views: DataFrame, required: Sequence[str], keys: Sequence[str] = ("pose_key",)) -> DataFrame:
    """Groups that show all required angles, with a dense pair index in key order."""
    g = views.where(F.col("angle").isin(list(required))).groupBy(*keys).agg(*[F.min(F.when(F.col("angle") == a, F.col("path"))).alias(a) for a in required])
    whole = g.dropna(subset=list(required))
    return rank_sorted(whole, list(keys)).withColumn("pair_index", F.col("rank") - 1).drop("rank")


def view_triplets(views: DataFrame, keys: Sequence[str] = ("char_id",)) -> DataFrame:
    """(source a, source b, target) for every target and pair of other views of a character.

    Views of one angle count once, so the views of a character are a short array, whatever the angles are called.
    Two views give two degenerate triplets, one view none.
    """
    one = views.where(F.col("angle").isNotNull()).groupBy(*keys, "angle").agg(F.min("path").alias("path"))
    g = one.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("angle", "path"))).alias("v")).withColumn("n", F.size("v"))
    many = g.where("n >= 3").select(*keys, "v", F.posexplode("v").alias("ti", "target"))
    many = many.select(*keys, "v", "ti", "target", F.posexplode("v").alias("ai", "a")).where("ai <> ti")
    many = many.select(*keys, "v", "ti", "ai", "target", "a", F.posexplode("v").alias("bi", "b")).where("bi > ai AND bi <> ti")
    two = g.where("n = 2").select(*keys, F.explode(F.array(
        F.struct(F.col("v")[0].alias("a"), F.col("v")[1].alias("b"), F.col("v")[1].alias("target")),
        F.struct(F.col("v")[1].alias("a"), F.col("v")[0].alias("b"), F.col("v")[0].alias("target")),
    )).alias("_t")).select(*keys, "_t.a", "_t.b", "_t.target")
    out = many.select(*keys, "a", "b", "target").unionByName(two)
    return out.select(*keys, F.col("a.path").alias("source_a"), F.col("b.path").alias("source_b"), F.col("target.path").alias("target"))


def resolve_rigs(bones: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(world position, rotation and scale of every bone of the sound rigs; bones that lead into a cycle: rig_id, bone). A missing parent makes a root.

    Rotations add and scales multiply along the path to the root, and with the parent's world
    rotation and scale known the positions are sums too. Both run by pointer doubling: each
    round joins a node with its current ancestor, so the rounds are logarithmic in the depth. A node that is still linked when the pointers span more bones than
    any rig has leads into a cycle; its rig is left out as a whole.
    """
    exists = bones.select("rig_id", F.col("bone").alias("parent"), F.lit(True).alias("_ok"))
    base = bones.join(exists, ["rig_id", "parent"], "left").withColumn("up", F.when(F.col("_ok"), F.col("parent")))
    turn = {"rotation": lambda a, b: a + b, "sx": lambda a, b: a * b, "sy": lambda a, b: a * b}
    first = base.select("rig_id", "bone", "up", F.col("up").alias("link"), "x", "y", "rotation", "sx", "sy")
    longest = bones.groupBy("rig_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    rounds = longest.bit_length()
    world, stuck = _to_root(first, turn, rounds)
    cyclic = stuck.select("rig_id", "bone")
    world = world.join(cyclic.select("rig_id").distinct(), "rig_id", "left_anti")
    p = world.select("rig_id", F.col("bone").alias("up"), *[F.col(c).alias(f"p_{c}") for c in turn])
    df = world.join(p, ["rig_id", "up"], "left")
    rad, lx, ly = F.radians("p_rotation"), F.col("x") * F.col("p_sx"), F.col("y") * F.col("p_sy")
    df = df.select(
        "rig_id", "bone", F.col("up").alias("link"), "rotation", "sx", "sy",
        F.when(F.col("up").isNull(), F.col("x")).otherwise(lx * F.cos(rad) - ly * F.sin(rad)).alias("wx"),
        F.when(F.col("up").isNull(), F.col("y")).otherwise(lx * F.sin(rad) + ly * F.cos(rad)).alias("wy"),
    )
    add = {"wx": lambda a, b: a + b, "wy": lambda a, b: a + b}
    return _to_root(df, add, rounds)[0].drop("link"), cyclic


def world_transform(bones: DataFrame) -> DataFrame:
    """World position, rotation and scale of every bone of the rigs without a cycle."""
    return resolve_rigs(bones)[0]


def cyclic_bones(bones: DataFrame) -> DataFrame:
    """Side table of :func:`world_transform`: bones from which no root is reached."""
    return resolve_rigs(bones)[1]


def _to_root(df: DataFrame, combine: Mapping, rounds: int) -> tuple[DataFrame, DataFrame]:
    """Fold ``combine`` along ``link`` pointers: (rows that reached a root, rows still linked after ``rounds`` doublings).

    A round writes the rows that are still open and reads those that are done; what is done is never written again.
    """
    state = cut(df)
    done, left = [state.where("link IS NULL")], state.where("link IS NOT NULL")
    for _ in range(rounds):
        if left.isEmpty():
            break
        known = left
        for part in done:
            known = known.unionByName(part)
        anc = known.select("rig_id", F.col("bone").alias("link"), F.col("link").alias("_next"), *[F.col(c).alias(f"_{c}") for c in combine])
        moved = left.join(anc, ["rig_id", "link"]).withColumns({c: f(F.col(f"_{c}"), F.col(c)) for c, f in combine.items()}).withColumn("link", F.col("_next"))
        state = cut(moved.select(*df.columns))
        done.append(state.where("link IS NULL"))
        left = state.where("link IS NOT NULL")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out, left


# --- counts and checks ---


def count_artifacts(files: DataFrame) -> DataFrame:
    """Files per source and category with the totals of both levels."""
    out = files.rollup("source", "category").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_g"))
    return out.select(F.when(F.col("_g") >= 2, "*").otherwise(F.col("source")).alias("source"), F.when(F.col("_g") >= 1, "*").otherwise(F.col("category")).alias("category"), "n")


def count_by(images: DataFrame, columns: Sequence[str] = ("style", "angle", "source")) -> DataFrame:
    """Image counts by each column in one aggregation."""
    sets = images.groupingSets([[c] for c in columns], *columns).agg(F.count(F.lit(1)).alias("n"), *[F.grouping(c).alias(f"_g_{c}") for c in columns])
    which = F.coalesce(*[F.when(F.col(f"_g_{c}") == 0, F.lit(c)) for c in columns])
    value = F.coalesce(*[F.when(F.col(f"_g_{c}") == 0, F.col(c)) for c in columns])
    return sets.select(which.alias("dimension"), value.alias("value"), "n")


def check_resolution(images: DataFrame, expected: int = dims.RESOLUTION) -> DataFrame:
    return images.where((F.col("width") != expected) | (F.col("height") != expected)).select("stem", "width", "height")


def check_summary(*checks: DataFrame) -> DataFrame:
    """Passed and failed per check from ``(check, item, passed)`` rows."""
    rows = checks[0]
    for c in checks[1:]:
        rows = rows.unionByName(c)
    return rows.groupBy("check").agg(F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"))


def as_check(df: DataFrame, name: str, item: str, passed: Column | str) -> DataFrame:
    p = F.col(passed) if isinstance(passed, str) else passed
    return df.select(F.lit(name).alias("check"), F.col(item).cast("string").alias("item"), p.alias("passed"))


def quality_info(results: DataFrame, sources: DataFrame) -> DataFrame:
    """Characters that failed, had failing poses, or have unmapped bones; one row each."""
    kind = F.when(F.col("error").isNotNull(), "failed").when(F.col("poses_failed") > 0, "warning")
    r = results.select(kind.alias("kind"), "char_id", F.when(kind == "warning", F.col("poses_failed")).alias("poses_failed")).where("kind IS NOT NULL")
    u = sources.where("unmapped").select(F.lit("unmapped_bones").alias("kind"), "char_id", F.lit(None).cast("long").alias("poses_failed"))
    return r.unionByName(u.distinct())


def dataset_manifest(counts: DataFrame, breakdown: DataFrame, distribution: DataFrame, info: DataFrame) -> DataFrame:
    """One report as (section, key, value) rows; every input is already an aggregate."""
    part = lambda df, s, k, v: df.select(F.lit(s).alias("section"), k.alias("key"), v.cast("double").alias("value"))
    out = part(counts, "files", F.concat_ws("/", "source", "category"), F.col("n"))
    out = out.unionByName(part(breakdown, "images", F.concat_ws("=", "dimension", "value"), F.col("n")))
    out = out.unionByName(part(distribution, "regions", F.col("class_name"), F.col("share")))
    kinds = info.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    return out.unionByName(part(kinds, "quality", F.col("kind"), F.col("n")))


def glob_regex(pattern: str) -> str:
    """``**/ortho/*.png`` as a regular expression over a relative path."""
    out, i = "", 0
    while i < len(pattern):
        if pattern.startswith("**/", i):
            out, i = out + "(?:.*/)?", i + 3
        elif pattern[i] == "*":
            out, i = out + "[^/]*", i + 1
        elif pattern[i] == "?":
            out, i = out + "[^/]", i + 1
        else:
            out, i = out + re.escape(pattern[i]), i + 1
    return f"^{out}$"


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    required: tuple[str, ...] = ()
    min_files: int = 0
    formats: tuple[str, ...] = field(default=())


def verify_spec(paths: DataFrame, specs: Sequence[DatasetSpec]) -> DataFrame:
    """File count, missing required patterns and wrong formats per specified dataset.

    The specs are a short fixed list, so all patterns are counted in one aggregation.
    """
    spark = paths.sparkSession
    name = F.element_at(F.split("path", "/"), -1)
    visible = paths.where(~name.startswith(".") & (F.lower(name) != "readme.md"))
    aggs, missing, wrong = [F.count(F.lit(1)).alias("file_count")], [], []
    ext = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    for i, s in enumerate(specs):
        mine = F.col("dataset") == s.name
        for j, pattern in enumerate(s.required):
            aggs.append(F.count_if(mine & F.col("path").rlike(glob_regex(pattern))).alias(f"_p{i}_{j}"))
            missing.append(F.when(mine & (F.coalesce(f"_p{i}_{j}", F.lit(0)) == 0), F.lit(f"no files matching '{pattern}'")))
        if s.min_files:
            missing.append(F.when(mine & (F.coalesce("file_count", F.lit(0)) < s.min_files), F.lit(f"fewer than {s.min_files} files")))
        if s.formats:
            aggs.append(F.count_if(mine & ext.isin(list(IMAGE_EXTENSIONS)) & ~ext.isin(list(s.formats))).alias(f"_f{i}"))
            wrong.append(F.when(mine, F.col(f"_f{i}")))
    known = spark.createDataFrame([(s.name,) for s in specs], "dataset string")
    df = F.broadcast(known).join(visible.groupBy("dataset").agg(*aggs), "dataset", "left")
    return df.select(
        "dataset", F.col("file_count").isNotNull().alias("present"), F.coalesce("file_count", F.lit(0)).cast("long").alias("file_count"),
        F.array_compact(F.array(*missing)).alias("missing"), F.coalesce(*wrong, F.lit(0)).cast("long").alias("wrong_format"),
    )


def build_example_metadata(examples: DataFrame, companions: Mapping[str, tuple[DataFrame, str]], source: Column, resolution: int = dims.RESOLUTION) -> DataFrame:
    """Flags per artifact and the list of missing annotations.

    ``companions`` maps an artifact to a table of keys and the key column it is joined on.
    """
    df = examples
    for name, (table, key) in companions.items():
        df = df.join(table.select(key).distinct().withColumn(f"_{name}", F.lit(True)), key, "left")
    has = {name: F.coalesce(f"_{name}", F.lit(False)) for name in companions}
    missing = F.array_compact(F.array(*[F.when(~c, F.lit(n)) for n, c in has.items()]))
    return df.select(
        *examples.columns, source.alias("dataset_source"), F.lit(resolution).alias("resolution"),
        *[c.alias(f"has_{n}") for n, c in has.items()], missing.alias("missing_annotations"),
    )


def assemble_training_set(
    images: DataFrame, masks: DataFrame, splits: DataFrame, rejected: DataFrame, weights: Mapping[str, float], split: str = "train",
    companions: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Examples of one split with a mask, without rejected ones, with their dataset weight, and ``has_{name}`` for each of ``companions`` (tables of ``view_key``, such as depth and normals)."""
    kept = scan_flat(images, masks).join(splits.where(F.col("split") == split).select("char_id").distinct(), "char_id", "left_semi")
    kept = kept.join(rejected.select("dataset", "example_id"), ["dataset", "example_id"], "left_anti")
    for name, table in (companions or {}).items():
        have = table.select(F.col("view_key").alias("mask_key"), F.lit(True).alias(f"_{name}")).distinct()
        kept = kept.join(have, "mask_key", "left").withColumn(f"has_{name}", F.col(f"_{name}").isNotNull()).drop(f"_{name}")
    weight = F.coalesce(*[F.when(F.col("dataset") == d, F.lit(float(w))) for d, w in weights.items()], F.lit(1.0))
    flags = [f"has_{name}" for name in companions or {}]
    return kept.select("dataset", "example_id", "char_id", "split_key" if "split_key" in kept.columns else "mask_key", weight.alias("dataset_weight"), *flags)


def training_counts(examples: DataFrame) -> DataFrame:
    """Examples per dataset, and how many have each companion."""
    flags = [c for c in examples.columns if c.startswith("has_")]
    return examples.groupBy("dataset").agg(F.count(F.lit(1)).alias("examples"), *[F.count_if(F.col(c)).alias(f"with_{c[4:]}") for c in flags])


# --- sampling and work lists ---


def capped_sample(df: DataFrame, key: str, n: int, seed: int | None = None) -> DataFrame:
    """First n keys in order, or a seeded random n."""
    order = F.col(key) if seed is None else F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.orderBy(order, key).limit(n)


def even_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """n evenly spaced rows in key order, all rows if there are fewer."""
    ranked = rank_sorted(df, [key], total="_total")
    r, last = F.col("rank") - 1, F.col("_total") - 1
    i = F.ceil(r * (n - 1) / F.nullif(last, F.lit(0)))
    hit = (F.col("_total") <= n) | (F.floor(i * last / (n - 1)) == r) if n > 1 else (r == 0)
    return ranked.where(hit).drop("rank", "_total")


def augmentation_grid(items: DataFrame, scales: Sequence[float] = (0.85, 1.0, 1.15), flip: bool = True, scale: bool = True) -> DataFrame:
    """Identity, scales, flip and flipped scales of every item."""
    extra = [s for s in scales if s != 1.0] if scale else []
    variants = [(False, 1.0), *[(False, s) for s in extra]] + ([(True, 1.0), *[(True, s) for s in extra]] if flip else [])
    grid = F.array(*[F.struct(F.lit(f).alias("flipped"), F.lit(float(s)).alias("scale")) for f, s in variants])
    return items.withColumn("_aug", F.explode(grid)).select(*items.columns, "_aug.flipped", "_aug.scale")


def render_plan(chars: DataFrame, done: DataFrame, poses: int, angles: Sequence[str], styles: Sequence[str]) -> DataFrame:
    """Character x pose x angle x style still to render; the dimensions are fixed lists."""
    plan = chars.select("char_id")
    if poses < 1:
        plan = plan.limit(0)
    for name, values in (("pose", F.sequence(F.lit(0), F.lit(max(0, poses - 1)))), ("angle", F.array(*map(F.lit, angles))), ("style", F.array(*map(F.lit, styles)))):
        plan = plan.withColumn(name, F.explode(values))
    return plan.join(done.select("char_id", "pose", "angle", "style"), ["char_id", "pose", "angle", "style"], "left_anti")


def prompt_rotation(ids: DataFrame, index: str, axes: Mapping[str, tuple[Sequence[str], int]], prefix: str = "SC") -> DataFrame:
    """Strided rotation through attribute lists: value = list[(index * stride) mod length]."""
    cols = {name: F.element_at(F.array(*[F.lit(v) for v in values]), (F.col(index) * stride % len(values) + 1).cast("int")) for name, (values, stride) in axes.items()}
    return ids.select(F.format_string(f"{prefix}-%03d", F.col(index) + 1).alias("prompt_id"), *[c.alias(n) for n, c in cols.items()])


def prompt_grid(ids: DataFrame, index: str, axes: Mapping[str, Sequence[str]], seed: int = 42) -> DataFrame:
    """Attribute combinations: a step coprime to their number visits each once before any comes again; ``cycle`` counts the rounds."""
    total = math.prod(len(v) for v in axes.values())
    step = next(s for s in range(int(total * 0.618) + seed % 7 + 1, 2 * total + 2) if math.gcd(s, total) == 1)
    place = (F.col(index).cast("long") * step + seed) % total
    cols, base = [], 1
    for name, values in axes.items():
        at = F.floor(place / base) % len(values)
        cols.append(F.element_at(F.array(*[F.lit(v) for v in values]), (at + 1).cast("int")).alias(name))
        base *= len(values)
    return ids.select(index, *cols, F.floor(F.col(index) / total).cast("long").alias("cycle"))

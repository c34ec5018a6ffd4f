"""Joins between run layers, points and cells of the same image.

Every join carries the equi keys ``(example_id, y)``; layer joins also cut runs at fixed
columns so a crowded scan line is compared bucket by bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskloom import dims
from maskloom.functions.ranking import null_safe_join
from maskloom.operators.components import new_key, whole_keys
from maskloom.session import dealt

BUCKET = 64
#: rows that a task hands on at once
ROWS = 100_000


def _bucketed(runs: DataFrame, bucket: int) -> DataFrame:
    """Cut runs at multiples of ``bucket``; ``x0`` and ``len`` become the clipped ones."""
    first, last = F.floor(F.col("x0") / bucket), F.floor((F.col("x0") + F.col("len") - 1) / bucket)
    df = runs.withColumn("_xb", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.col("x0"), F.col("_xb") * bucket)
    hi = F.least(F.col("x0") + F.col("len"), (F.col("_xb") + 1) * bucket)
    return df.withColumns({"_lo": lo, "_hi": hi}).drop("x0", "len")


def mask_overlap(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("example_id",), a_cols: Sequence[str] = (), b_cols: Sequence[str] = (), bucket: int = BUCKET) -> DataFrame:
    """Common pixels of two layers, summed per ``keys`` and the wanted columns of each side."""
    on = [*keys, "y", "_xb"]
    left = _bucketed(a.select(*keys, "y", "x0", "len", *a_cols), bucket)
    right = _bucketed(b.select(*keys, "y", "x0", "len", *b_cols), bucket)
    right = right.withColumnsRenamed({"_lo": "_lo2", "_hi": "_hi2"})
    common = F.least("_hi", "_hi2") - F.greatest("_lo", "_lo2")
    both = left.join(right, on).where(common > 0)
    return both.groupBy(*keys, *a_cols, *b_cols).agg(F.sum(common).cast("long").alias("pixels"))


def silhouette_overlap(mask: DataFrame, alpha: DataFrame, keys: Sequence[str] = ("example_id",)) -> DataFrame:
    """Foreground, silhouette and common pixels of every image in either layer."""
    ks = list(keys)
    fg = mask.where("class_id > 0")
    common = mask_overlap(fg, alpha, ks).withColumnRenamed("pixels", "covered_px")
    a = alpha.groupBy(*ks).agg(F.sum("len").cast("long").alias("alpha_px"))
    m = fg.groupBy(*ks).agg(F.sum("len").cast("long").alias("fg_px"))
    out = m.join(a, ks, "full_outer").join(common, ks, "left")
    return out.select(*ks, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("fg_px", "alpha_px", "covered_px")])


def mask_completeness(mask: DataFrame, alpha: DataFrame, keys: Sequence[str] = ("example_id",)) -> DataFrame:
    """Opaque pixels without a label: count and percent."""
    o = silhouette_overlap(mask, alpha, keys)
    open_px = F.col("alpha_px") - F.col("covered_px")
    pct = F.when(F.col("alpha_px") > 0, open_px / F.col("alpha_px") * 100).otherwise(0.0)
    return o.select(*keys, open_px.alias("unmapped"), F.bround(pct, 1).alias("percent"), (open_px == 0).alias("passed"))


def labels_at_points(points: DataFrame, runs: DataFrame, keys: Sequence[str] = ("example_id",)) -> DataFrame:
    """Label under each point; points on no run get NULL. ``points`` needs integer x, y and ``point_id``."""
    r = runs.select(*keys, "y", F.col("x0").alias("_x0"), F.col("len").alias("_len"), F.col("class_id").alias("label"))
    hit = (F.col("x") >= F.col("_x0")) & (F.col("x") < F.col("_x0") + F.col("_len"))
    found = points.select(*keys, "point_id", "x", "y").join(r, [*keys, "y"]).where(hit).select(*keys, "point_id", "label")
    return points.join(found, [*keys, "point_id"], "left")


def joint_in_label_rate(joints: DataFrame, runs: DataFrame) -> DataFrame:
    """Share of joints that lie on their own class."""
    pts = joints.select("example_id", F.col("class_id").alias("point_id"), "x", "y")
    at = labels_at_points(pts, runs)
    ok = F.count_if(F.col("label") == F.col("point_id"))
    return at.groupBy("example_id").agg(
        ok.alias("matched"), F.count(F.lit(1)).alias("total"), F.bround(ok / F.count(F.lit(1)), 4).alias("match_rate")
    )


def _grid_region(rel_x: Column, rel_y: Column) -> Column:
    """Region from the place in the figure when an image has no joints."""
    left, right = rel_x < -0.15, rel_x > 0.15
    side = lambda l, r, mid: F.when(left, l).when(right, r).otherwise(mid)
    half = lambda l, r: F.when(rel_x < 0, l).otherwise(r)
    return (
        F.when(rel_y < 0.15, 1).when(rel_y < 0.20, 2).when(rel_y < 0.40, side(7, 11, 3)).when(rel_y < 0.50, side(8, 12, 4))
        .when(rel_y < 0.55, side(9, 13, 5)).when(rel_y < 0.75, half(14, 17)).when(rel_y < 0.90, half(15, 18)).otherwise(half(16, 19))
    )


def figure_box(silhouette: DataFrame) -> DataFrame:
    """Box of the foreground runs of each example: left, top, and the distance to the last column and row."""
    end = F.max(F.col("x0") + F.col("len") - 1)
    return silhouette.groupBy("example_id").agg(
        F.min("x0").alias("left"), F.min("y").alias("top"), F.greatest(end - F.min("x0"), F.lit(1)).alias("box_w"), F.greatest(F.max("y") - F.min("y"), F.lit(1)).alias("box_h"))


def assign_nearest(segments: DataFrame, joints: DataFrame, width: int, height: int, min_pixels: int = 10, silhouette: DataFrame | None = None) -> DataFrame:
    """Region of every segment: the joint inside it (nearest to its centroid if several), else the
    nearest joint, else the place in the figure's box (of ``silhouette`` runs; the frame for an example without any). A segment meets at most the 19 joints of its image.
    """
    pts = joints.groupBy("example_id", "class_id").agg(F.min(F.struct("x", "y")).alias("p"))
    pts = pts.groupBy("example_id").agg(F.collect_list(F.struct("class_id", "p.x", "p.y")).alias("_pts"))  # at most one per class
    rows = segments.select("example_id", "segment", "y", "x0", "len").join(pts, "example_id", "left")
    within = F.filter("_pts", lambda p: (p["y"] == F.col("y")) & (p["x"] >= F.col("x0")) & (p["x"] < F.col("x0") + F.col("len")))
    hit = F.transform(within, lambda p: p["class_id"])
    seg = rows.groupBy("example_id", "segment").agg(
        F.sum("len").alias("pixels"), (F.sum(F.col("len") * (2 * F.col("x0") + F.col("len") - 1) / 2.0) / F.sum("len")).alias("cx"),
        (F.sum(F.col("y") * F.col("len")) / F.sum("len")).alias("cy"), F.flatten(F.collect_set(F.when(F.size(hit) > 0, hit))).alias("_in"), F.first("_pts").alias("_pts"),
    ).where(F.col("pixels") >= min_pixels)

    def order(p: Column) -> Column:
        dist = F.pow(p["x"] - F.col("cx"), 2) + F.pow(p["y"] - F.col("cy"), 2)
        return F.struct(F.coalesce(~F.array_contains("_in", p["class_id"]), F.lit(True)).alias("out"), F.round(dist, 6).alias("d"), p["class_id"].alias("c"))

    best = F.array_min(F.transform("_pts", order))["c"]
    out = seg.withColumn("_joint", F.when(F.col("segment").isNotNull(), best)).drop("_in", "_pts")
    frame = {"left": 0, "top": 0, "box_w": max(width - 1, 1), "box_h": max(height - 1, 1)}
    if silhouette is not None:
        out = out.join(figure_box(silhouette), "example_id", "left")
    left, top, fw, fh = (F.coalesce(F.col(c), F.lit(v)) if silhouette is not None else F.lit(v) for c, v in frame.items())
    grid = _grid_region((F.col("cx") - (left + fw / 2)) / (fw / 2), (F.col("cy") - top) / fh)
    return out.select("example_id", "segment", F.coalesce("_joint", grid).cast("int").alias("region"))


def reprojection_error(measured: DataFrame, projected: DataFrame, keys: Sequence[str] = ("sample",)) -> DataFrame:
    """Mean and maximum pixel error per sample; joints without a projection do not count."""
    p = projected.select(*keys, "joint", "px", "py")
    df = measured.join(p, [*keys, "joint"], "left")
    # errors count in hundredths of a pixel, so the mean is exact
    err = F.bround(F.sqrt(F.pow(F.col("px") - F.col("x"), 2) + F.pow(F.col("py") - F.col("y"), 2)) * 100, 0).cast("long")
    inf = F.lit(float("inf"))
    return df.groupBy(*keys).agg(
        F.coalesce(F.bround(F.sum(err) / F.count(err), 0) / 100, inf).alias("mean_error_px"), F.coalesce(F.max(err) / 100, inf).alias("max_error_px"),
        F.count(err).alias("num_joints"),
    )


def union_masks(instances: DataFrame, keys: Sequence[str] = ("example_id",)) -> DataFrame:
    """Foreground runs covering all instances: one pass over each scan line.

    The longest run per start comes first, so a line holds at most as many rows as it has pixels.
    """
    line = [*keys, "y"]
    instances = dealt(instances.select(*line, "x0", "len"), *line).groupBy(*line, "x0").agg(F.max("len").alias("len"))
    w = Window.partitionBy(*line).orderBy("x0")
    end = F.col("x0") + F.col("len")
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    df = instances.withColumn("_new", F.coalesce(F.col("x0") > reach, F.lit(True)).cast("int"))
    df = df.withColumn("_isle", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = df.groupBy(*line, "_isle").agg(F.min("x0").alias("x0"), F.max(end).alias("_end"))
    return out.select(*line, "x0", (F.col("_end") - F.col("x0")).cast("int").alias("len"))


def _rand(parts: Column, word: int, lo: int, hi: Column | int) -> Column:
    """Seeded integer in lo..hi from one 32-bit word of a digest."""
    bits = F.conv(F.substring(parts, 1 + 8 * word, 8), 16, 10).cast("long")
    return (F.lit(lo) + bits % ((hi if isinstance(hi, Column) else F.lit(hi)) - lo + 1)).cast("int")


def occlusion_rect_pairs(
    runs: DataFrame, width: int, height: int, masks: int = 2, tries: int = 5, seed: int = 42, low: float = 0.05, high: float = 0.5, min_fg: float = 0.05
) -> DataFrame:
    """One to three seeded rectangles per mask; the first try that hides 5-50 % of the figure is kept.

    The rectangles follow from a digest of the example id. They are made once per example, and its runs meet them in a join.
    """
    grid = F.array(*[F.struct(F.lit(m).alias("mask"), F.lit(t).alias("try")) for m in range(masks) for t in range(tries)])
    rects = runs.select("example_id").distinct().select("example_id", F.explode(grid).alias("_grid")).select("example_id", "_grid.*")
    name = F.concat_ws(":", F.lit(str(seed)), F.col("example_id").cast("string"), F.col("mask").cast("string"), F.col("try").cast("string"))
    rects = rects.withColumns({"_name": name, "_count": _rand(F.md5(name), 0, 1, 3)})
    for i in range(3):
        rects = rects.withColumn("_d", F.md5(F.concat_ws(":", "_name", F.lit(str(i)))))
        rects = rects.withColumns({f"_h{i}": _rand(F.col("_d"), 0, height // 8, height // 3), f"_w{i}": _rand(F.col("_d"), 1, width // 8, width // 3)})
        rects = rects.withColumns({
            f"_t{i}": F.when(F.lit(i) < F.col("_count"), _rand(F.col("_d"), 2, 0, F.lit(height) - F.col(f"_h{i}"))), f"_l{i}": _rand(F.col("_d"), 3, 0, F.lit(width) - F.col(f"_w{i}"))})
    df = null_safe_join(runs.select("example_id", "y", "x0", "len"), rects.drop("_name", "_count", "_d"), ["example_id"])
    spans = []
    for i in range(3):
        top, left = F.col(f"_t{i}"), F.col(f"_l{i}")
        on = (F.col("y") >= top) & (F.col("y") < top + F.col(f"_h{i}"))
        lo, hi = F.greatest(F.col("x0"), left), F.least(F.col("x0") + F.col("len"), left + F.col(f"_w{i}"))
        df = df.withColumns({f"_a{i}": F.when(on, lo), f"_b{i}": F.when(on, hi)})
        spans.append((F.col(f"_a{i}"), F.col(f"_b{i}")))

    def meet(ids: Sequence[int]) -> Column:
        lo = F.col(f"_a{ids[0]}") if len(ids) == 1 else F.greatest(*[spans[i][0] for i in ids])
        hi = F.col(f"_b{ids[0]}") if len(ids) == 1 else F.least(*[spans[i][1] for i in ids])
        known = spans[ids[0]][0].isNotNull()
        for i in ids[1:]:
            known = known & spans[i][0].isNotNull()
        return F.when(known, F.greatest(hi - lo, F.lit(0))).otherwise(0)

    hidden = meet([0]) + meet([1]) + meet([2]) - meet([0, 1]) - meet([0, 2]) - meet([1, 2]) + meet([0, 1, 2])
    cov = df.groupBy("example_id", "mask", "try").agg(F.sum("len").alias("fg"), F.sum(hidden).alias("hidden"))
    share = F.col("hidden") / F.col("fg")
    ok = cov.where((F.col("fg") / (width * height) >= min_fg) & (share >= low) & (share <= high))
    first = F.min(F.struct("try", "hidden", "fg")).alias("b")
    out = ok.groupBy("example_id", "mask").agg(first)
    return out.select("example_id", "mask", "b.try", F.col("b.hidden").cast("long").alias("hidden_px"), F.col("b.fg").cast("long").alias("fg_px"))


def densify(cells: DataFrame, width: int, height: int) -> DataFrame:
    """Every cell of every example, absent cells as class 0."""
    ids = cells.select("example_id").distinct()
    frame = ids.withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(height - 1)))).withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
    out = frame.join(cells, ["example_id", "x", "y"], "left")
    return out.withColumn("class_id", F.coalesce("class_id", F.lit(0)))


def boundary_cells(grid: DataFrame, radius: int = 2, exclude: Sequence[int] = ()) -> DataFrame:
    """Foreground cells whose square neighbourhood holds more than one class.

    Maximum and minimum are separable: one window along the row, one along the column; a
    window partition is one line of one image.
    """
    row = Window.partitionBy("example_id", "y").orderBy("x").rangeBetween(-radius, radius)
    col = Window.partitionBy("example_id", "x").orderBy("y").rangeBetween(-radius, radius)
    df = grid.withColumns({"_hi": F.max("class_id").over(row), "_lo": F.min("class_id").over(row)})
    df = df.withColumns({"_hi": F.max("_hi").over(col), "_lo": F.min("_lo").over(col)})
    df = df.where((F.col("_hi") != F.col("_lo")) & F.col("class_id").between(1, dims.NUM_CLASSES - 1))
    if exclude:
        df = df.where(~F.col("class_id").isin(list(exclude)))
    return df.select("example_id", "x", "y", "class_id")


def _blur(plane: np.ndarray, axis: int, kernel: Sequence[float]) -> np.ndarray:
    """One pass of a separable blur with reflected edges."""
    reach, size = len(kernel) // 2, plane.shape[axis]
    at = np.arange(-reach, size + reach)
    at = np.where(at < 0, -at - 1, np.where(at >= size, 2 * size - 1 - at, at))
    wide = np.take(plane, np.clip(at, 0, size - 1), axis)
    beyond = (at < 0) | (at >= size)  # a frame smaller than the kernel is mirrored once
    wide[(slice(None),) * axis + (beyond,)] = 0.0
    return sum(k * np.take(wide, np.arange(i, i + size), axis) for i, k in enumerate(kernel))


def _soft_cells(x: np.ndarray, y: np.ndarray, c: np.ndarray, width: int, height: int, radius: int, kernel: Sequence[float], exclude: Sequence[int], absent: int | None) -> list[np.ndarray]:
    """x, y, class and share of one example's cells; classes are blurred one after the other."""
    inside = (x >= 0) & (x < width) & (y >= 0) & (y < height)
    x, y, c = x[inside], y[inside], c[inside]
    if absent is not None:
        free = np.ones((height, width), bool)
        free[y, x] = False
        more = np.nonzero(free)
        x, y, c = np.concatenate([x, more[1]]), np.concatenate([y, more[0]]), np.concatenate([c, np.full(len(more[0]), absent)])
    hi, lo = np.full((height, width), np.iinfo(np.int64).min), np.full((height, width), np.iinfo(np.int64).max)
    np.maximum.at(hi, (y, x), c)
    np.minimum.at(lo, (y, x), c)
    for axis, size in ((1, width), (0, height)):
        for plane, better in ((hi, np.maximum), (lo, np.minimum)):
            seen = plane.copy()
            for d in range(1, min(radius, size - 1) + 1):
                low, high = ((slice(None),) * axis + (s,) for s in (slice(0, size - d), slice(d, size)))
                plane[low] = better(plane[low], seen[high])
                plane[high] = better(plane[high], seen[low])
    soft = (c >= 1) & (c < dims.NUM_CLASSES) & (hi[y, x] != lo[y, x]) & ~np.isin(c, list(exclude))
    edge = np.zeros((height, width), bool)
    edge[y[soft], x[soft]] = True
    known = (c >= 0) & (c < dims.NUM_CLASSES)
    ey, ex = np.nonzero(edge)
    kinds = np.unique(c[known])
    mix = np.zeros((len(kinds), len(ex)))
    for i, kind in enumerate(kinds if len(ex) else ()):
        plane = np.zeros((height, width))
        np.add.at(plane, (y[c == kind], x[c == kind]), 1.0)
        mix[i] = _blur(_blur(plane, 1, kernel), 0, kernel)[ey, ex]
    which, cell = np.nonzero(mix)
    share = (mix / np.maximum(mix.sum(0), 1e-8))[which, cell]
    hard = known & ~edge[y, x]
    return [np.concatenate(p) for p in ((ex[cell], x[hard]), (ey[cell], y[hard]), (kinds[which], c[hard]), (share, np.ones(hard.sum())))]


def soften_labels(
    grid: DataFrame, width: int, height: int, radius: int = 2, sigma: float = 1.0, exclude: Sequence[int] = (), absent: int | None = None
) -> DataFrame:
    """Gaussian class mix on boundary cells, one-hot elsewhere; edges reflect. Cells lie in the frame; with ``absent``, those that an example does not have are of that class.

    The cells travel once, by example; a task blurs one frame after the other, so neither the frames nor the mixtures are shuffled.
    """
    reach = int(4.0 * sigma + 0.5)
    raw = [math.exp(-0.5 * (d / sigma) ** 2) for d in range(-reach, reach + 1)]
    kernel = [v / sum(raw) for v in raw]
    kinds = dict(grid.dtypes)
    schema = pa.schema([("x", pa.int32()), ("y", pa.int32()), ("class_id", pa.int32()), ("p", pa.float64())])

    def soften(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_keys(batches, ["example_id"]):
            starts = np.flatnonzero(new_key(table, ["example_id"]))
            x, y, c = (table[n].to_numpy().astype(np.int64) for n in ("x", "y", "class_id"))
            parts, ids, n = [], [], 0
            for lo, hi in zip(starts, [*starts[1:], table.num_rows], strict=True):
                parts.append(_soft_cells(x[lo:hi], y[lo:hi], c[lo:hi], width, height, radius, kernel, exclude, absent))
                ids.append(lo)
                n += len(parts[-1][0])
                if n >= ROWS or hi == table.num_rows:
                    of = table["example_id"].take(pa.array(np.repeat(ids, [len(p[0]) for p in parts]))).combine_chunks()
                    cols = [pa.array(np.concatenate([p[k] for p in parts])).cast(schema.field(k).type) for k in range(4)]
                    yield pa.RecordBatch.from_arrays([of, *cols], names=["example_id", *schema.names])
                    parts, ids, n = [], [], 0

    kind = F.col("class_id") if absent is None else F.coalesce("class_id", F.lit(absent))
    cells = grid.select("example_id", F.col("x").cast("int").alias("x"), F.col("y").cast("int").alias("y"), kind.cast("int").alias("class_id")).dropna(subset=["x", "y", "class_id"])
    out = dealt(cells, "example_id").sortWithinPartitions("example_id").mapInArrow(soften, f"example_id {kinds['example_id']}, x int, y int, class_id int, p double")
    return out.select("example_id", *[F.col(n).cast(kinds[n]).alias(n) for n in ("x", "y", "class_id")], "p")

"""Connected components of label masks (4-neighbourhood) over run rows.

Runs are sorted by mask and tile, and a batch of many tiles is labelled at once. A mask no
larger than a tile (the usual case) is one tile; a larger raster is cut into tiles, so no
tile grows with it, and the tile components are merged over the tile borders by joins.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.operators.masks import EXAMPLE
from maskloom.session import cut, dealt

TILE = 512


def new_key(table: pa.Table, names: Sequence[str]) -> np.ndarray:
    """True where a row differs from the one before in any of the columns; null equals null."""
    new = np.ones(table.num_rows, bool)
    new[1:] = False
    for name in names:
        col = table[name]
        a, b = col.slice(1), col.slice(0, max(table.num_rows - 1, 0))
        differ = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
        new[1:] |= differ.to_numpy()
    return new


def _roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest row of every row's component, for pairs (u, v) of rows that touch: larger roots hook to smaller ones, then paths are halved."""
    root = np.arange(n)
    while len(u):
        a, b = root[u], root[v]
        live = a != b
        u, v, a, b = u[live], v[live], a[live], b[live]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := root[root], root):
            root = up
    return root


def _lines(plane: np.ndarray, y: np.ndarray, x0: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, int]:
    """Of runs sorted by plane, y and x0: where lines begin, and begins and ends (exclusive) of runs on one axis, line * width + x - left, with its width and left."""
    y_new = np.ones(len(y), bool)
    y_new[1:] = (plane[1:] != plane[:-1]) | (y[1:] != y[:-1])
    line = np.cumsum(y_new) - 1
    left = int(x0.min(initial=0)) - 1
    width = int((x0 + size).max(initial=1) - left) + 2
    begins = line * width + (x0 - left)
    return y_new, begins, begins + size, width, left


def _spans(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which span, number) of all numbers from lo up to hi of each span."""
    met = np.maximum(hi - lo, 0)
    return np.repeat(np.arange(len(lo)), met), np.repeat(lo - np.cumsum(met) + met, met) + np.arange(met.sum())


def _components(plane: np.ndarray, y: np.ndarray, x0: np.ndarray, size: np.ndarray) -> np.ndarray:
    """First row of the component of every run; runs are sorted by plane, y and x0, and only those of a plane touch."""
    y_new, begins, ends, width, _ = _lines(plane, y, x0, size)
    line, first = np.cumsum(y_new) - 1, np.flatnonzero(y_new)
    # the line above, if the plane has runs there
    above = np.full(len(first), -1)
    above[1:] = np.where((plane[first[1:]] == plane[first[:-1]]) & (y[first[1:]] == y[first[:-1]] + 1), np.arange(len(first) - 1), -1)
    reach = np.maximum.accumulate(ends)  # how far a line is covered up to a run
    touch = np.flatnonzero(~y_new[1:] & (reach[:-1] >= begins[1:])) + 1
    low = np.flatnonzero(above[line] >= 0)
    up = (above[line[low]] - line[low]) * width
    lo = np.maximum(np.searchsorted(reach, begins[low] + up, side="right"), first[above[line[low]]])
    which, at = _spans(lo, np.searchsorted(begins, ends[low] + up, side="left"))
    return _roots(len(y), np.concatenate([touch - 1, at]).astype(np.int64), np.concatenate([touch, low[which]]).astype(np.int64))


def _label_tiles(table: pa.Table) -> pa.RecordBatch:
    """Components of whole tiles, sorted by tile, class, y and x0; the root is the first run in (y, x) order."""
    y, x0, size = (table[c].to_numpy().astype(np.int64) for c in ("y", "x0", "len"))
    root = _components(np.cumsum(new_key(table, [*EXAMPLE, "_ty", "_tx", "class_id"])), y, x0, size)
    cols = {c: table[c].combine_chunks() for c in table.column_names}
    cols["root_y"], cols["root_x"] = (pa.array(v[root].astype(np.int32)) for v in (y, x0))
    return pa.RecordBatch.from_pydict(cols)


def whole_keys(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[pa.Table]:
    """Sorted rows in tables of whole keys, many small ones at once; the last key of a batch waits for its rest."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        edge = pa.Table.from_batches([*(b.slice(b.num_rows - 1) for b in held[-2:-1]), batch])  # the row before tells whether its key goes on
        starts = np.flatnonzero(new_key(edge, names))
        last = int(starts[-1]) - (len(held) > 1)
        if starts[-1] > 0:  # a key begins in this batch
            yield pa.Table.from_batches([*held[:-1], batch.slice(0, last)])
            held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held)


def _label_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_keys(batches, [*EXAMPLE, "_ty", "_tx"]):
        yield _label_tiles(table)


def _split_at_tiles(runs: DataFrame, tile: int) -> DataFrame:
    """Runs crossing a tile column are cut there; the sum of pixels is unchanged."""
    first, last = F.floor(F.col("x0") / tile), F.floor((F.col("x0") + F.col("len") - 1) / tile)
    parts = runs.withColumn("_tx", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.col("x0"), F.col("_tx") * tile)
    hi = F.least(F.col("x0") + F.col("len"), (F.col("_tx") + 1) * tile)
    return parts.withColumns({"_lo": lo, "_hi": hi}).select(
        *EXAMPLE, F.col("class_id").cast("int").alias("class_id"), F.col("y").cast("int").alias("y"),
        F.col("_lo").cast("int").alias("x0"), (F.col("_hi") - F.col("_lo")).cast("int").alias("len"),
        F.floor(F.col("y") / tile).cast("int").alias("_ty"), F.col("_tx").cast("int").alias("_tx"),
    )


def label_runs(runs: DataFrame, tile: int = TILE) -> DataFrame:
    """Every foreground run with the (y, x) of the first run of its component."""
    fg = runs.where("class_id > 0").select(*EXAMPLE, "class_id", "y", "x0", "len")
    kinds = dict(fg.dtypes)
    parts = _split_at_tiles(fg, tile)
    schema = f"dataset {kinds['dataset']}, example_id {kinds['example_id']}, class_id int, y int, x0 int, len int, _ty int, _tx int, root_y int, root_x int"
    tiles = [*EXAMPLE, "_ty", "_tx"]
    labelled = dealt(parts, *tiles).sortWithinPartitions(*tiles, "class_id", "y", "x0").mapInArrow(_label_batches, schema)
    return _merge_tiles(cut(labelled), tile).drop("_ty", "_tx")


def _merge_tiles(labelled: DataFrame, tile: int) -> DataFrame:
    node = F.struct("root_y", "root_x")
    keys = [*EXAMPLE, "class_id"]
    rows = labelled.withColumn("node", node)
    up = rows.where(F.pmod(F.col("y"), F.lit(tile)) == 0).select(*keys, (F.col("y") - 1).alias("y"), F.col("x0").alias("_x"), F.col("len").alias("_l"), F.col("node").alias("b"))
    low = rows.where(F.pmod(F.col("y"), F.lit(tile)) == tile - 1).select(*keys, "y", "x0", "len", F.col("node").alias("a"))
    vertical = low.join(up, [*keys, "y"]).where((F.col("_x") < F.col("x0") + F.col("len")) & (F.col("x0") < F.col("_x") + F.col("_l")))
    right = rows.where(F.pmod(F.col("x0"), F.lit(tile)) == 0).select(*keys, "y", F.col("x0").alias("_e"), F.col("node").alias("b"))
    left = rows.withColumn("_e", F.col("x0") + F.col("len")).where(F.pmod(F.col("_e"), F.lit(tile)) == 0).select(*keys, "y", "_e", F.col("node").alias("a"))
    horizontal = left.join(right, [*keys, "y", "_e"])
    edges = cut(vertical.select(*keys, "a", "b").unionByName(horizontal.select(*keys, "a", "b")).distinct())
    if edges.isEmpty():  # nothing touches a tile border
        return labelled
    merged = contract(edges, keys)
    out = rows.join(merged, [*keys, "node"], "left")
    best = F.coalesce("label", "node")
    return out.select(*[c for c in labelled.columns if c not in ("root_y", "root_x")], best["root_y"].alias("root_y"), best["root_x"].alias("root_x"))


def _digest(edges: DataFrame, keys: Sequence[str]) -> tuple:
    """Count and two sums of hashes of distinct edges: equal for equal sets, without a shuffle of the edges."""
    hashed = [F.sum(F.xxhash64(*keys, "a", "b", F.lit(i)).cast("decimal(38,0)")).alias(f"h{i}") for i in (1, 2)]
    return tuple(edges.agg(F.count(F.lit(1)).alias("n"), *hashed).first())


def contract(edges: DataFrame, keys: Sequence[str], max_rounds: int = 60) -> DataFrame:
    """Smallest node of every node's component, by alternating large-star and small-star steps.

    Each step is a min aggregation and an equi-join; the edges are cut into the checkpoint
    folder every round, and the number of rounds is logarithmic in the component size.
    """
    keys = list(keys)
    e = cut(edges.where(F.col("a") != F.col("b")).select(*keys, F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = _digest(e, keys)
    for _ in range(max_rounds):
        if not seen[0]:
            return e.select(*keys, F.col("a").alias("node"), F.col("b").alias("label"))
        both = e.unionByName(e.select(*keys, F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(*keys, "a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, [*keys, "a"]).where(F.col("b") > F.col("a")).select(*keys, F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where(F.col("a") != F.col("b")).distinct()
        down = large.groupBy(*keys, "a").agg(F.min("b").alias("m"))
        small = large.join(down, [*keys, "a"])
        small = small.select(*keys, F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("s"))
        nxt = cut(small.select(*keys, "s.a", "s.b").where(F.col("a") != F.col("b")).distinct())
        now, e = _digest(nxt, keys), nxt
        changed, seen = now != seen, now
        if not changed:
            return e.select(*keys, F.col("a").alias("node"), F.col("b").alias("label"))
    raise RuntimeError("components did not converge")


def component_table(labelled: DataFrame) -> DataFrame:
    """Area and bounding box of every component."""
    return labelled.groupBy(*EXAMPLE, "class_id", "root_y", "root_x").agg(
        F.sum("len").cast("long").alias("area"), F.min("x0").alias("x_min"), F.min("y").alias("y_min"),
        F.max(F.col("x0") + F.col("len") - 1).alias("x_max"), F.max("y").alias("y_max"),
    )


def component_counts(labelled: DataFrame) -> DataFrame:
    """Number of components per mask and class. Each is told by its first run; dealt by mask, further groups by mask need no more exchange."""
    first = labelled.where("y = root_y AND x0 = root_x")
    per = dealt(first.select(*EXAMPLE, "class_id", "root_y", "root_x"), *EXAMPLE).distinct()
    return per.groupBy(*EXAMPLE, "class_id").agg(F.count(F.lit(1)).alias("components"))


def _votes(mask: np.ndarray, kind: np.ndarray, y: np.ndarray, x0: np.ndarray, size: np.ndarray, root: np.ndarray, small: np.ndarray, frame: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(root, class) of the small components that have neighbouring cells in the frame; ``small`` are their runs."""
    width, height = frame
    which, x = _spans(x0[small], x0[small] + size[small])
    comp, line = root[small[which]], y[small[which]]
    cells = np.concatenate([comp] * 5), np.concatenate([line, line - 1, line, line, line + 1]), np.concatenate([x, x, x - 1, x + 1, x])
    inside = (cells[1] >= 0) & (cells[1] < height) & (cells[2] >= 0) & (cells[2] < width)
    own = np.arange(len(inside)) < len(x)
    cell = (cells[0] * height + cells[1]) * width + cells[2]
    cell = np.setdiff1d(cell[inside & ~own], cell[inside & own])
    comp, line, x = cell // (width * height), cell // width % height, cell % width
    # the runs over a cell: those of its line that begin up to it and end after it
    order = np.lexsort((x0, y, mask))
    y_new, begins, ends, span, left = _lines(mask[order], y[order], x0[order], size[order])
    low = min(int(y.min()), 0)
    high = max(int(y.max()), height) - low + 1
    names = (mask * high + y - low)[order[y_new]]
    wanted = mask[comp] * high + line - low
    at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
    place = np.where((names[at] == wanted) & (x > left) & (x < left + span), at * span + x - left, -1)
    of, run = _spans(np.searchsorted(np.maximum.accumulate(ends), place, side="right"), np.searchsorted(begins, place, side="right"))
    over = ends[run] > place[of]
    of, run = of[over], order[run[over]]
    bare = np.ones(len(cell), bool)
    bare[of] = False
    comp, taken = np.concatenate([comp[bare], comp[of]]), np.concatenate([np.zeros(bare.sum(), np.int64), kind[run]])
    kinds, number = np.unique(taken, return_inverse=True)
    pair, votes = np.unique(comp * len(kinds) + number, return_counts=True)
    comp, number = pair // max(len(kinds), 1), pair % max(len(kinds), 1)
    best = np.lexsort((number, -votes, comp))
    best = best[np.unique(comp[best], return_index=True)[1]]
    return comp[best], kinds[number[best]]


def _absorb(table: pa.Table, frame: tuple[int, int], min_area: int, step: int, halo: int) -> pa.RecordBatch:
    """Runs of the cores of whole tiles with their classes after small components are absorbed."""
    known = np.ones(table.num_rows, bool)
    for name in ("y", "x0", "len"):
        known &= table[name].is_valid().to_numpy()
    mask = np.cumsum(new_key(table, [*EXAMPLE, "_ty", "_tx"]))[known]
    kind, y, x0, size, ty, tx = (table[c].filter(pa.array(known)).to_numpy().astype(np.int64) for c in ("class_id", "y", "x0", "len", "_ty", "_tx"))
    core, new = ~known, table["class_id"].to_numpy().astype(np.int32)
    core[known] = ((x0 + halo) // step == tx) & ((y + halo) // step == ty)
    order = np.lexsort((x0, y, kind, mask))
    mask, kind, y, x0, size = (v[order] for v in (mask, kind, y, x0, size))
    plane = np.zeros(len(order), np.int64)
    plane[1:] = np.cumsum((mask[1:] != mask[:-1]) | (kind[1:] != kind[:-1]))
    root = _components(plane, y, x0, size)
    small = np.flatnonzero(np.bincount(root, size, minlength=len(root))[root] < min_area)
    if len(small):
        comp, taken = _votes(mask, kind, y, x0, size, root, small, frame)
        of_root = kind.copy()
        of_root[comp] = taken
        new[np.flatnonzero(known)[order[small]]] = of_root[root[small]]
    cols = {c: table[c].combine_chunks() for c in (*EXAMPLE, "y", "x0", "len")} | {"class_id": pa.array(new)}
    return pa.RecordBatch.from_pydict(cols).filter(pa.array(core))


def absorb_small_components(runs: DataFrame, width: int, height: int, min_area: int = 50, tile: int = TILE) -> DataFrame:
    """Components below ``min_area`` take the most frequent class of their neighbouring cells.

    All components are judged on the mask as it comes in; ties go to the lower class; cells
    without a run are background. Only small components are expanded into cells.

    A task labels and judges whole tiles, so nothing is stored and rows travel once. A tile also gets
    the runs up to ``min_area`` beyond its border: a small component that begins in the tile lies
    within, with its surroundings, and a larger one shows ``min_area`` cells at least. Masks up to
    ``tile`` are one tile. Runs without a place keep their class.
    """
    halo = max(1, min_area)
    step = max(tile, halo) + 2 * halo
    fg = runs.where("class_id > 0").select(*EXAMPLE, *[F.col(c).cast("int").alias(c) for c in ("class_id", "y", "x0", "len")])
    kinds = dict(fg.dtypes)
    # the tiles that begin at a multiple of step less halo, with their surroundings
    placed = F.col("y").isNotNull() & F.col("x0").isNotNull() & F.col("len").isNotNull()
    near = lambda first, last: F.explode(F.when(placed, F.sequence(F.floor(first / step), F.floor((last + 2 * halo) / step))).otherwise(F.array(F.lit(0).cast("long"))))
    parts = fg.withColumn("_ty", near(F.col("y"), F.col("y"))).withColumn("_tx", near(F.col("x0"), F.col("x0") + F.greatest("len", F.lit(1)) - 1))
    tiles = ["_ty", "_tx"]
    schema = f"dataset {kinds['dataset']}, example_id {kinds['example_id']}, y int, x0 int, len int, class_id int"

    def absorb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_keys(batches, [*EXAMPLE, *tiles]):
            yield _absorb(table, (width, height), min_area, step, halo)

    return dealt(parts, *EXAMPLE, *tiles).sortWithinPartitions("example_id", "dataset", *tiles).mapInArrow(absorb, schema)

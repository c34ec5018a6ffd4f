"""Components with tiny tiles against a flood fill."""

import re

import numpy as np
import pytest

from maskloom.operators import components as C


def runs_of(mask, example):
    out = []
    for y, row in enumerate(mask):
        x = 0
        while x < len(row):
            end = x
            while end < len(row) and row[end] == row[x]:
                end += 1
            if row[x] > 0:
                out.append(("d", example, y, x, end - x, int(row[x])))
            x = end
    return out


def flood(mask):
    seen, areas = np.zeros(mask.shape, bool), []
    for y, x in zip(*np.nonzero(mask)):
        if seen[y, x]:
            continue
        stack, area = [(y, x)], 0
        seen[y, x] = True
        while stack:
            a, b = stack.pop()
            area += 1
            for i, j in ((a + 1, b), (a - 1, b), (a, b + 1), (a, b - 1)):
                if 0 <= i < mask.shape[0] and 0 <= j < mask.shape[1] and not seen[i, j] and mask[i, j] == mask[y, x]:
                    seen[i, j] = True
                    stack.append((i, j))
        areas.append((int(mask[y, x]), area))
    return sorted(areas)


@pytest.mark.parametrize("tile", [3, 8, 512])
def test_components_match_flood_fill(spark, tile):
    rng = np.random.default_rng(tile)
    masks = [rng.integers(0, 3, (14, 17)), np.ones((9, 20), int), np.where(np.indices((12, 12)).sum(0) % 5 < 4, 2, 0)]
    spiral = np.zeros((13, 13), int)
    spiral[0, :], spiral[:, 12], spiral[12, 1:], spiral[2:, 1] = 1, 1, 1, 1
    masks.append(spiral)
    rows = [r for i, m in enumerate(masks) for r in runs_of(m, i)]
    df = spark.createDataFrame(rows, "dataset string, example_id int, y int, x0 int, len int, class_id int")
    got = C.component_table(C.label_runs(df, tile)).collect()
    for i, m in enumerate(masks):
        assert sorted((r.class_id, r.area) for r in got if r.example_id == i) == flood(m)


def test_small_components_take_the_surrounding_class(spark):
    mask = np.full((6, 6), 3)
    mask[2, 2] = 5
    mask[5, 5] = 7
    df = spark.createDataFrame(runs_of(mask, 1), "dataset string, example_id int, y int, x0 int, len int, class_id int")
    out = C.absorb_small_components(df, 6, 6, min_area=2)
    assert {r.class_id for r in out.collect()} == {3}


def test_isolated_component_becomes_background(spark):
    df = spark.createDataFrame([("d", 1, 2, 2, 1, 4)], "dataset string, example_id int, y int, x0 int, len int, class_id int")
    assert [r.class_id for r in C.absorb_small_components(df, 6, 6).collect()] == [0]


@pytest.mark.parametrize("size", [1, 7, 10_000])
def test_tiles_are_labelled_in_batches(size):
    import pyarrow as pa

    rng = np.random.default_rng(size)
    masks = [rng.integers(0, 3, (12, 15)) for _ in range(20)]
    rows = [r for i, m in enumerate(masks) for r in sorted(runs_of(m, i), key=lambda r: (r[5], r[2], r[3]))]
    names = ["dataset", "example_id", "y", "x0", "len", "class_id"]
    table = pa.table({k: list(v) for k, v in zip(names, zip(*rows))} | {"_ty": [0] * len(rows), "_tx": [0] * len(rows)})
    got = pa.Table.from_batches(C._label_batches(iter(table.to_batches(max_chunksize=size)))).to_pylist()
    assert len(got) == len(rows)
    for i, m in enumerate(masks):
        areas = {}
        for r in got:
            if r["example_id"] == i:
                key = r["class_id"], r["root_y"], r["root_x"]
                areas[key] = areas.get(key, 0) + r["len"]
        assert sorted((k[0], v) for k, v in areas.items()) == flood(m)


def test_surroundings_are_not_fanned_out_before_a_shuffle(spark):
    rng = np.random.default_rng(5)
    rows = [r for i in range(3) for r in runs_of(rng.integers(0, 4, (9, 9)), i)]
    out = C.absorb_small_components(spark.createDataFrame(rows, "dataset string, example_id int, y int, x0 int, len int, class_id int"), 9, 9, min_area=5)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Aggregate \[[^\]]*[^_]y#", plan), plan  # no cells as keys
    assert out.count() == len(rows)


def test_components_are_counted_with_one_exchange(spark):
    """By mask and class, and then by mask; equal runs and runs that overlap count once."""
    rows = [("a", 1, 1, 0, 0, 4), ("a", 1, 1, 1, 2, 4), ("a", 1, 1, 5, 0, 2), ("a", 1, 1, 5, 0, 2), ("a", 1, 1, 5, 1, 3), ("a", 1, 2, 9, 0, 1), ("b", 1, 1, 3, 3, 3)]
    runs = spark.createDataFrame(rows, "dataset string, example_id long, class_id int, y int, x0 int, len int")
    counts = C.component_counts(C.label_runs(runs, 2))
    assert sorted(map(tuple, counts.collect())) == [("a", 1, 1, 2), ("a", 1, 2, 1), ("b", 1, 1, 1)]
    most = C.component_counts(C.label_runs(runs)).groupBy("dataset", "example_id").agg({"components": "max"})
    assert most._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def absorbed(runs, width, height, min_area):
    """Class of every run (y, x0, len, class) of a mask, with sets of cells."""
    root = list(range(len(runs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (y, x, n, c) in enumerate(runs):
        for j, (b, z, m, d) in enumerate(runs[:i]):
            if c == d and (y == b and x <= z + m and z <= x + n or abs(y - b) == 1 and x < z + m and z < x + n):
                root[find(i)] = find(j)
    cells = lambda i: {(runs[i][0], x) for x in range(runs[i][1], runs[i][1] + runs[i][2])}
    over, parts = {}, {}
    for i in range(len(runs)):
        parts.setdefault(find(i), []).append(i)
        for cell in cells(i):
            over.setdefault(cell, []).append(runs[i][3])
    out = [r[3] for r in runs]
    for part in parts.values():
        if sum(runs[i][2] for i in part) < min_area:
            own = set().union(*map(cells, part))
            near = {(y + a, x + b) for y, x in own for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1))} - own
            votes = {}
            for cell in near:
                if 0 <= cell[0] < height and 0 <= cell[1] < width:
                    for c in over.get(cell, [0]):
                        votes[c] = votes.get(c, 0) + 1
            for i in part if votes else []:
                out[i] = min(votes, key=lambda c: (-votes[c], c))
    return out


@pytest.mark.parametrize(("tile", "min_area"), [(2, 4), (8, 9), (512, 9), (16, 1)])
def test_absorbed_masks_match_sets_of_cells(spark, tile, min_area):
    """Frames of many tiles, runs that overlap, repeat, leave the frame or have no place, and masks without a dataset."""
    rng = np.random.default_rng(tile)
    masks = [rng.choice(4, (33, 47), p=[0.3, 0.4, 0.2, 0.1]), np.kron(rng.integers(0, 3, (11, 12)), np.ones((3, 4), int)), np.ones((40, 40), int)]
    rows = [("d" if i else None, *r[1:]) for i, m in enumerate(masks) for r in runs_of(m, i)]
    for _ in range(120):
        rows.append(("odd", 9, int(rng.integers(-3, 40)), int(rng.integers(-6, 44)), int(rng.integers(0, 7)), int(rng.integers(1, 4))))
    rows += rows[-5:] + [("odd", 9, None, 3, 2, 1), ("odd", 9, 3, None, 2, 2), ("odd", 9, 4, 44, None, 3), ("odd", 9, 1, 1, 2, 0)]
    runs = spark.createDataFrame(rows, "dataset string, example_id int, y int, x0 int, len int, class_id int")
    want = [(*r, r[5]) for r in rows if None in r[2:5]]
    for mask in {r[:2] for r in rows}:
        own = [r for r in rows if r[:2] == mask and None not in r[2:5] and r[5] > 0]
        want += [(*r, c) for r, c in zip(own, absorbed([r[2:] for r in own], 44, 38, min_area))]
    got = C.absorb_small_components(runs, 44, 38, min_area, tile)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str((*r[:5], r[6])) for r in want)


def test_absorbing_stores_nothing_and_moves_rows_once(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [r for i in range(4) for r in runs_of(rng.integers(0, 4, (9, 30)), i)]
    runs = spark.createDataFrame(rows, "dataset string, example_id int, y int, x0 int, len int, class_id int")
    monkeypatch.setattr(C, "cut", lambda df: pytest.fail("rows are stored"))
    for tile in (4, 512):
        out = C.absorb_small_components(runs, 30, 9, min_area=3, tile=tile)
        assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        assert out.count() == len(rows)

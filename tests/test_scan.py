"""Motion by segmented scans: any chunk length gives what a loop over frames gives."""

import math
import random

import pytest

from maskloom.operators import series as S

BONES = ("hips", "chest")


def clips(rnd):
    out = {}
    for clip in range(14):
        n = rnd.choice([1, 2, 3, 5, 17, 40])
        style = rnd.random()
        for bone in BONES:
            v, rows = [0.0, 0.0, 0.0], []
            for _ in range(n):
                step = lambda: rnd.choice([-5, -3, -1, 0, 0, 1, 3, 5]) * (style > 0.15)  # noqa: B023, E731
                v = [x + step() for x in v]
                rows.append(tuple(v))
            out[clip, bone] = rows
    return out


def frame_rows(data):
    return [(c, f, b, *map(float, v)) for (c, b), rows in data.items() for f, v in enumerate(rows)]


def anticipated(data, threshold=2.0, max_run=10):
    gone = set()
    for (clip, _), rows in data.items():
        n = len(rows) - 1
        for axis in range(3):
            values = [r[axis] for r in rows]
            if max(values) - min(values) < threshold:
                continue
            starts, last = [], None
            for i in range(n):
                d = values[i + 1] - values[i]
                if abs(d) >= threshold:
                    if last is None or (d > 0) != last:
                        starts.append(i)
                    last = d > 0
            for a, s in enumerate(starts[:-1]):
                end1 = starts[a + 1]
                end2 = starts[a + 2] if a + 2 < len(starts) else n
                if end1 - s <= max_run and end2 - end1 > end1 - s:
                    gone |= {(clip, f) for f in range(s + 1, end1 + 1) if 0 < f < n}
    return gone


def extremes(data, least=3):
    kept = {}
    for (clip, _), rows in data.items():
        n = len(rows)
        mine = kept.setdefault(clip, {0, n - 1})
        for axis in range(3):
            v = [r[axis] for r in rows]
            if max(v) - min(v) > 1:
                mine |= {i for i in range(1, n - 1) if v[i] >= max(v[i - 1], v[i + 1]) or v[i] <= min(v[i - 1], v[i + 1])}
    lengths = {c: len(r) for (c, _), r in data.items()}
    return {(c, f) for c, k in kept.items() for f in (k | set(range(0, lengths[c], max(1, lengths[c] // least))) if len(k) < least else k)}


def resampled(data):
    out = {}
    for clip in {c for c, _ in data}:
        tracks = {b: data[clip, b] for b in BONES}
        n = len(tracks[BONES[0]])
        place = [0.0]
        for i in range(1, n):
            place.append(place[-1] + sum(math.dist(t[i], t[i - 1]) for t in tracks.values()))
        for i in range(n):
            want = place[-1] * i / (n - 1) if n > 1 else 0.0
            for b, t in tracks.items():
                if place[-1] < 1e-6:
                    out[clip, i, b] = t[i]
                    continue
                j = max(k for k in range(n) if place[k] <= want + 1e-7)
                share = 0 if j == n - 1 or place[j + 1] == place[j] else (want - place[j]) / (place[j + 1] - place[j])
                nxt = t[min(j + 1, n - 1)]
                out[clip, i, b] = tuple(a + (z - a) * share for a, z in zip(t[j], nxt, strict=True))
    return out


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 1000])
def test_chunks_of_any_length(spark, chunk):
    data = clips(random.Random(chunk))
    frames = spark.createDataFrame(frame_rows(data), "clip long, frame int, bone string, rx double, ry double, rz double").cache()
    assert {tuple(r) for r in S.anticipation_frames(frames, chunk=chunk).collect()} == anticipated(data)
    assert {tuple(r) for r in S.extreme_frames(frames, chunk=chunk).collect()} == extremes(data)
    got = S.at_samples(frames, S.arc_samples(frames, chunk=chunk)).collect()
    want = resampled(data)
    assert len(got) == len(want)
    for r in got:
        assert (r.rx, r.ry, r.rz) == pytest.approx(want[r.clip, r.frame, r.bone], abs=1e-4)


def exchanges(df):
    df.collect()
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1].split("== Initial Plan ==")[0].count("Exchange hashpartitioning")


def test_few_shuffles(spark):
    frames = spark.createDataFrame(frame_rows(clips(random.Random(1))), "clip long, frame int, bone string, rx double, ry double, rz double")
    assert exchanges(S.anticipation_frames(frames)) <= 12
    assert exchanges(S.extreme_frames(frames)) <= 12

"""Merkle manifests against a tree built by hand."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from maskloom.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in FIELDS])


def levels(nodes, fanout):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def steps(tree, at, fanout):
    out = []
    for level in tree[:-1]:
        lo = at - at % fanout
        run = level[lo : lo + fanout]
        out.append((run[: at - lo], run[at - lo + 1 :]))
        at //= fanout
    return out


def expected(rows, fanout, change):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        groups[name].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = [levels([leaf(r) for r in groups[n]], fanout) for n in names]
    top = levels([t[-1][0] for t in trees], fanout) if names else []
    out = []
    for g, name in enumerate(names):
        for i, r in enumerate(groups[name]):
            path = steps(trees[g], i, fanout) + steps(top, g, fanout)
            digest = leaf(change(r))
            for left, right in path:
                digest = h(*left, digest, *right)
            out.append((r["doc_id"], leaf(r), trees[g][-1][0], top[-1][0], h(*[x for left, right in path for x in left + right]), digest))
    return sorted(out, key=repr)


def got(docs, fanout=16):
    fields = [F.col(c) for c in FIELDS]
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    changed = F.when(struck, merkle.leaf([*fields[:-1], F.lower("text")]))
    rows = merkle.manifest(docs, "source", "doc_id", fields, changed, fanout)
    return rows.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")), merkle.fold(F.coalesce("changed", "leaf"), F.col("path")))


def lowered(row):
    from zlib import crc32

    if row["doc_id"] is None or crc32(str(row["doc_id"]).encode()) % 5 or row["text"] is None:
        return row
    return row | {"text": row["text"].lower()}


def compare(docs, fanout=16):
    rows = [r.asDict() for r in docs.select(*FIELDS).collect()]
    assert sorted([tuple(r) for r in got(docs, fanout).collect()], key=repr) == expected(rows, fanout, lowered)


def test_odd_rows(make_docs, odd_rows):
    compare(make_docs(odd_rows))


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_all_sizes_of_groups(make_docs, fanout):
    """Lone leaves, whole and broken runs, a hot group, more groups than a run holds, repeated rows and null keys."""
    rnd = random.Random(fanout)
    rows = []
    for g, size in enumerate([1, 2, fanout, fanout + 1, fanout**2, fanout**2 + 1, 300, *[1] * (fanout + 2)]):
        rows += [(rnd.choice([None, rnd.randrange(10_000), 7]), f"Text {rnd.randrange(50)} OF {g}", rnd.choice(["en", None, ""]), None if g == 4 else f"s{g}é") for _ in range(size)]
    compare(make_docs(rows), fanout)


def test_one_group_and_one_row(make_docs):
    compare(make_docs([(5, "Only ONE", "en", "a")]))
    compare(make_docs([(i, "T", "en", None) for i in range(40)]))


def test_no_rows(make_docs):
    assert got(make_docs([])).collect() == []


def test_a_change_shows(make_docs):
    docs = make_docs([(i, f"Text {i}", "en", f"s{i % 3}") for i in range(100)])
    for r in got(docs).collect():
        from zlib import crc32

        assert (r[5] == r[3]) == (crc32(str(r[0]).encode()) % 5 != 0)

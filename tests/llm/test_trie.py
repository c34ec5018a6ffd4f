"""Prefix tries against one built turn by turn."""

import hashlib
import random
from zlib import crc32

from maskloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, name string, depth string, pos string, n_convs string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "n", "d", "p", "c") for r in rows], SCHEMA)


def expected(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", (text or "")[: prefix_trie.TIE], hashlib.sha256((text or "").encode()).digest(), text or ""))
    own = {c: [(t[2], t[5]) for t in sorted(x)] for c, x in convs.items()}
    built = {}
    for c, turns in own.items():
        n = crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = own.get(base, [])[:n] + turns[n:]
    members, kids = {}, {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
            if d:
                kids.setdefault(tuple(turns[: d - 1]), set()).add(tuple(turns[:d]))
    total = {}
    for node in sorted(members, key=len, reverse=True):
        own_saved = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        below = [total[k] for k in kids.get(node, ())]
        total[node] = (sum(b[0] for b in below) if below else 1, own_saved + sum(b[1] for b in below))
    out = []
    for node, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if len(built[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(who), len(node), parent, len(who), len(kids.get(node, ())), *total[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows):
    got = prefix_trie.trie(table(spark, rows))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted([tuple(r) for r in got.collect()], key=repr) == expected(rows)


def test_odd_rows(spark):
    rows = [
        (0, None, "user", "null turn first"), (0, 0, "user", "a"), (0, 1, None, None), (0, 1, "assistant", "b"), (0, 1, "assistant", "b"), (0, 2, "", ""), (1, 0, "user", "a"), (2, 5, "user", "only"),
        (None, 0, "user", "nobody"), (-5, 0, "user", "negative"), (-5, 1, "user", "é日😀"), (-150, 0, "user", "a"), (250, 0, "user", "no base"), (250, 3, "assistant", "x" * 200_000), (7, 0, "user", "a"),
        (7, 0, "user", "a" * 70 + "2"), (7, 0, "user", "a" * 70 + "1"), (301, 0, "user", "turnless perhaps"), (302, 0, "user", "turnless perhaps"), (305, 0, "user", "x"),
    ]
    check(spark, rows)


def test_no_rows(spark):
    check(spark, [])
    check(spark, [(None, 1, "user", "x")])


def test_one_turn(spark):
    check(spark, [(0, 0, "user", "x")])
    check(spark, [(c, 0, "user", "same") for c in range(40)])


def test_hot_first_turns_and_deep_branches(spark):
    rnd = random.Random(5)
    rows = []
    for c in range(0, 400):
        deep = rnd.choice([1, 2, 3, 5, 8, 9, 33])
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", "hello" if t == 0 and c % 3 else rnd.choice(["yes", "no", "maybe so"])) for t in range(deep)]
    # one conversation much deeper than all others, and two that share 130 turns
    rows += [(1000, t, "user", f"t{t}") for t in range(300)]
    rows += [(c, t, "user", f"t{t}" if t < 130 else f"{c}-{t}") for c in (1001, 1002) for t in range(140)]
    check(spark, rows)


def test_ids_of_one_node_are_hashed_in_order_of_number(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    check(spark, [(c, t, "user", f"same {t}") for c in [*range(95, 130), *range(990, 1020), -3, -20] for t in range(8)])

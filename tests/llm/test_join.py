"""The similarity join against all pairs."""

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from maskloom.llm import ngram_join
from maskloom.llm import text as scan


def shingle_set(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_force(rows):
    """{doc_id: (sizes, component)} by comparing all pairs."""
    held = [(i, shingle_set(t)) for i, t, *_ in rows if i is not None]
    root = {i: i for i, _ in held}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, x), (b, y) in combinations(held, 2):
        common = len(x & y)
        if common and 100 * common >= 80 * (len(x) + len(y) - common):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in root}


def check(spark, make_docs, rows):
    got = ngram_join.components(make_docs(rows)).collect()
    want = brute_force(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles) for r in got) == sorted((i is None, i or 0, len(shingle_set(t))) for i, t, *_ in rows)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert all(r.component_id is None for r in got if r.doc_id is None)


def near_copies(seed, sizes, copies, passage):
    """Texts of different lengths, copies with edits around the threshold, and unrelated texts that share a passage."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(5000)}"
    shared = [word() for _ in range(passage)]
    rows, n = [], 0
    for size in sizes:
        base = [word() for _ in range(size)]
        for _ in range(copies):
            own = list(base)
            for _ in range(rnd.randrange(0, max(2, size // 22))):
                at = rnd.randrange(len(own))
                if rnd.random() < 0.5:
                    own[at] = word()
                else:
                    own.insert(at, word())
            rows.append((n, " ".join(own), "en", "s"))
            n += 1
        rows.append((n, " ".join([word() for _ in range(size)] + shared), "en", "s"))
        n += 1
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_of_all_sizes(spark, make_docs, seed):
    check(spark, make_docs, near_copies(seed, [1, 3, 4, 5, 6, 8, 9, 10, 13, 14, 20, 30, 45, 70, 110, 210, 230, 400, 900], 6, 40))


def test_hot_group_of_copies_and_a_common_passage(spark, make_docs):
    rows = near_copies(3, [60] * 3, 60, 50) + [(1000 + i, "one two three four five six seven eight", "en", "s") for i in range(200)]
    check(spark, make_docs, rows)


def test_odd_rows(spark, make_docs, odd_rows):
    check(spark, make_docs, odd_rows)


def test_no_rows(spark, make_docs):
    assert ngram_join.components(make_docs([])).count() == 0


def test_similar_sets_share_a_signature():
    """The guarantee itself, at the threshold: every pair at Jaccard 0.8 or more shares a signature in more than the spare groups of each."""
    rnd = np.random.default_rng(5)
    for size in (1, 4, 5, 9, 12, 27, 60, 150, 300, 1000):
        for _ in range(20):
            common = int(np.ceil(0.8 * size))
            pool = rnd.choice(1 << 40, 2 * size, replace=False).astype(np.uint64)
            a = np.sort(pool[:size])
            b = np.sort(np.concatenate([pool[size - common : size], pool[size : size + max(0, int(common / 0.8) - size)]]))
            inter = len(np.intersect1d(a, b))
            if inter < 0.8 * (len(a) + len(b) - inter):
                continue
            row = np.repeat([0, 1], [len(a), len(b)])
            r, sig, slot = ngram_join.signatures(row, np.concatenate([a, b]), np.array([len(a), len(b)]))
            shared = np.intersect1d(sig[r == 0], sig[r == 1])
            assert len(shared)
            for own in (0, 1):
                mine = (r == own) & np.isin(sig, shared)
                groups = {}
                for n, s in enumerate(slot[mine].tolist()):
                    groups.setdefault(s & 1, set()).add((s >> 1 & 255, n if s >> 1 & 255 == ngram_join.ALONE else 0))
                spare = {s & 1: s >> 9 for s in slot[mine].tolist()}
                assert any(len(groups[band]) > spare[band] for band in groups)


def test_one_document_of_each_group_stays(spark, make_docs, odd_rows):
    rows = near_copies(4, [30, 80], 5, 10) + [(i if i is None else i + 5000, t, a, b) for i, t, a, b in odd_rows]
    got = ngram_join.representatives(make_docs(rows)).collect()
    want = brute_force(rows)
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted({i for i, label in want.items() if i == label})
    assert sum(r.doc_id is None for r in got) == sum(i is None for i, *_ in rows)
    assert list(got[0].asDict()) == make_docs([]).columns


def test_chunks_do_not_change_sets():
    texts = pa.array(["a b c d e f", None, "", "a b", "A b c d e F"])
    whole = [ngram_join.sets(c) for c in scan.chunks(texts)]
    small = [ngram_join.sets(c) for c in scan.chunks(texts, size=4)]
    assert len(small) > 1
    assert np.concatenate([v for _, v in whole]).tolist() == np.concatenate([v for _, v in small]).tolist()


def brute_links(rows):
    """{doc_id: number of other ids with a similar text} by comparing all pairs."""
    held = [(i, shingle_set(t)) for i, t, *_ in rows if i is not None]
    linked = {i: set() for i, _ in held}
    for (a, x), (b, y) in combinations(held, 2):
        common = len(x & y)
        if a != b and common and 100 * common >= 80 * (len(x) + len(y) - common):
            linked[a].add(b)
            linked[b].add(a)
    return {i: len(x) for i, x in linked.items()}


@pytest.mark.parametrize("shingles, members", [(ngram_join.BLOCK_SHINGLES, ngram_join.BLOCK_SETS), (300, 5)])
def test_all_links_are_counted(spark, make_docs, odd_rows, monkeypatch, shingles, members):
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", shingles)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", members)
    rows = near_copies(5, [3, 9, 30, 60, 61, 200], 25, 20) + [(1000 + i, f"{'same ' * 3}{' '.join(map(str, range(30)))}", "en", "s") for i in range(20)]
    rows += [(2000 + i % 7, rows[i * 3][1], "en", "s") for i in range(20)]  # ids with several texts, copies of others
    rows += [(i if i is None else i + 5000, t, a, b) for i, t, a, b in odd_rows]
    got = {r.doc_id: r.n_links for r in ngram_join.components(make_docs(rows)).collect() if r.doc_id is not None}
    assert got == brute_links(rows)


def test_buckets_do_not_depend_on_batch_borders(monkeypatch):
    monkeypatch.setattr(ngram_join, "LARGE", 4)
    sig = np.repeat([1, 2, 3, 4], [5, 6, 1, 2])
    rows = {"sig": sig, "doc": np.arange(len(sig)), "slot": np.zeros(len(sig), np.int32)}

    def run(*cuts):
        batch, edges = pa.RecordBatch.from_pydict(rows), [0, *cuts, len(sig)]
        parts = [batch.slice(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return [r for out in ngram_join._buckets(iter(parts)) for r in out.to_pylist()]

    want = run()
    assert all(run(*cuts) == want for k in (1, 2, 3) for cuts in combinations(range(1, len(sig)), k))


def test_buckets_need_no_order_of_documents(monkeypatch):
    monkeypatch.setattr(ngram_join, "LARGE", 6)
    rnd = np.random.default_rng(4)
    sig = np.sort(rnd.integers(0, 60, 150))
    sig = np.concatenate([sig, np.full(20, 99)])
    doc = rnd.integers(-20, 20, len(sig))
    held = {s: sorted(set(doc[sig == s].tolist())) for s in set(sig.tolist())}
    for size in (1, 3, 7, 50, len(sig)):
        for slots in (False, True):
            batch = pa.RecordBatch.from_pydict({"sig": sig, "doc": doc} | ({"slot": np.arange(len(sig), dtype=np.int32)} if slots else {}))
            got = [r for out in ngram_join._buckets(batch.slice(a, size) for a in range(0, len(sig), size)) for r in out.to_pylist()]
            found = {}
            for r in got:
                found.setdefault(r["sig"], []).append(r)
            assert {s for s, docs in held.items() if len(docs) > 1} == {s for s, rows in found.items() if rows[0]["n"] < 6 or len(held[s]) > 1}
            for s, rows in found.items():
                assert {r["doc"] for r in rows} == set(held[s])
                if rows[0]["n"] < 6:  # left as a whole
                    assert [r["doc"] for r in rows] == held[s] and all((r["rep"], r["n"]) == (held[s][0], len(held[s])) for r in rows)


def test_signatures_are_sorted_by_one_number(spark, make_docs, monkeypatch):
    plans = []
    put = ngram_join.Stored.put

    def noted(self, df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return put(self, df, name)

    monkeypatch.setattr(ngram_join.Stored, "put", noted)
    ngram_join.links_and_components(make_docs([(i, "a b c d e f g h", "en", "z") for i in range(20)]))
    for name in ("shared", "members"):
        plan = next(p for n, p in plans if n == name)
        order = re.findall(r"Sort \[([^\]]*)\]", plan)
        assert order and all("," not in o for o in order)



def test_released_memory_has_no_tables_of_powers():
    data = np.arange(300, dtype=np.uint8)
    want = scan.prefix_hash(data)
    assert scan._powers
    scan.release_memory()
    assert not scan._powers and (scan.prefix_hash(data) == want).all()


def test_texts_do_not_travel(spark, make_docs):
    """What is shuffled depends on sets and signatures, not on the bytes of the texts, even where no table is broadcast by its size."""
    rnd = random.Random(7)
    texts = [" ".join(rnd.randbytes(6000).hex() for _ in range(3)) for _ in range(150)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts * 2)]
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway

    def shuffled():
        stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = make_docs(rows).coalesce(2).cache()
        docs.count()
        before = shuffled()
        got = ngram_join.components(docs).collect()
        moved = shuffled() - before
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r.doc_id: r.component_id for r in got} == {i: i % 150 for i in range(300)}
    assert moved < sum(len(t) for _, t, *_ in rows) / 8


@pytest.mark.parametrize("bits", [1 << 27, 1 << 15])
def test_texts_of_keeps_every_wanted_row(spark, monkeypatch, bits):
    """However small the table of bits is; rows beside the wanted ones are few as long as it grows with the ids."""
    monkeypatch.setattr(ngram_join, "MOST_BITS", bits)
    docs = spark.range(-30_000, 30_000).selectExpr("nullif(id, 7) AS doc_id", "cast(id AS string) AS text")
    ids = spark.range(-30_000, 30_000, 10).selectExpr("nullif(id, 0) AS doc_id").unionByName(spark.range(3).selectExpr("1L AS doc_id"))
    got = [r.doc_id for r in ngram_join.texts_of(docs, ids).collect()]
    assert None not in got and len(got) == len(set(got))
    assert set(got) >= {i for i in range(-30_000, 30_000, 10) if i} | {1}
    assert len(got) < (12_000 if bits > 1 << 15 else 24_000)

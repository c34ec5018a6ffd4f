"""Operators on texts against plain Python, with odd rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from maskloom.llm import byte_bpe, license_scan, mixing, quality_rules, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})


# 9: byte-level BPE


def test_bpe_as_the_library_and_back(spark, make_docs, odd_rows, library):
    rnd = random.Random(2)
    more = ["aaaa" * 60 + " bb" * 20, "日本語のテキスト" * 30, "😀👍🏽 x 　y\x1c\x85z", "I'll don't WE'VE", "\x00\x01�", "".join(chr(rnd.randrange(32, 0x2FFF)) for _ in range(2000)), "  \n\n\t x  "]
    rows = odd_rows + [(100 + i, t, "en", "z") for i, t in enumerate(more)]
    got = byte_bpe.round_trip(make_docs(rows), PATH, PATTERN)
    assert set(got.columns) == {*make_docs([]).columns, "decoded"}
    want = Counter((i, np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t, *_ in rows)
    assert Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got.collect()) == want
    coded = byte_bpe.encode(make_docs(rows), PATH, PATTERN)
    assert sorted(bytes(r.decoded) for r in byte_bpe.decode(coded, PATH, PATTERN).collect()) == sorted(x[2] for x in want.elements())


def test_bpe_long_pieces_and_a_full_store(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KEPT", 10)
    monkeypatch.setattr(byte_bpe, "PIECE_BYTES", 50)
    own, rnd = byte_bpe.Coder(PATH, PATTERN), random.Random(3)
    for n in (byte_bpe.LONG - 1, byte_bpe.LONG, byte_bpe.LONG + 1, 5000):
        texts = ["".join(rnd.choice("etaoinshrdlu") for _ in range(n)), "x" * n, "one two three"]
        assert own.encode(texts) == [np.array(library.encode_ordinary(t), "<u4").tobytes() for t in texts]
        assert own.decode(own.encode(texts)) == [t.encode() for t in texts]


def test_bpe_no_rows(spark, make_docs):
    assert byte_bpe.round_trip(make_docs([]), PATH, PATTERN).count() == 0


def test_bpe_tasks_leave_nothing_to_the_worker(library):
    own = byte_bpe.coder(PATH, PATTERN)
    texts = ["the quick brown fox", "zq" * 400, None]
    work = byte_bpe._tasks(PATH, PATTERN, [], True, True)
    for _ in range(2):
        got = [r for b in work(iter([pa.RecordBatch.from_pydict({"text": texts})])) for r in b.to_pylist()]
        assert [(r["ids"], r["decoded"]) for r in got] == [(np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for t in texts]
        assert not own.known and not own.old and not {"con", "merged"} & set(vars(own))


def test_bpe_rounds_have_no_window(library):
    own = byte_bpe.Coder(PATH, PATTERN)
    own.encode(["words of a text"])  # registers start_rows
    plan = own.con.sql("EXPLAIN " + byte_bpe.ENCODE_SQL).fetchall()[0][1].lower()
    assert "rec cte" in plan and "window" not in plan


# 5: mixing


def expected_targets(sizes, epochs=3, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed, free = float(sum(sizes.values())), {}, set(sizes)
    while free:
        level = (total - sum(fixed.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > epochs * sizes[s]}
        if not over:
            break
        fixed |= {s: float(epochs * sizes[s]) for s in over}
        free -= over
    return fixed | {s: level * weight[s] for s in free}


def check_mix(got, rows):
    sizes, taken = Counter(), Counter()
    for _, t, _, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want = expected_targets(sizes)
    for r in got:
        assert r.mix_size == len(WORD.findall(r.text or "")) and r.mix_taken <= 3 * r.mix_size
        assert r.mix_taken == r.mix_copies * r.mix_size + r.mix_fraction
        assert r.mix_source_size == sizes[r.source] and r.mix_target == pytest.approx(want[r.source])
        taken[r.source] += r.mix_taken
    for s, n in taken.items():
        assert abs(n - want[s]) <= 1


def test_mix_meets_its_targets(spark, make_docs, odd_rows):
    rnd = random.Random(1)
    rows = odd_rows + [(100 + i, " ".join(["w"] * rnd.randrange(1, 90)), "en", f"s{min(i % 11, 4)}") for i in range(600)]
    got = mixing.mix(make_docs(rows))
    first = got.collect()
    check_mix(first, rows)
    assert Counter(map(tuple, first)) == Counter(map(tuple, got.repartition(3).collect()))
    assert Counter(map(tuple, first)) == Counter(map(tuple, mixing.mix(make_docs(rows).repartition(5)).collect()))
    assert Counter((r.doc_id, r.mix_taken) for r in first) != Counter((r.doc_id, r.mix_taken) for r in mixing.mix(make_docs(rows), seed=1).collect())
    texts = mixing.repeated(got, make_docs([]).columns)
    assert texts.columns == make_docs([]).columns
    copies = Counter((r.doc_id, r.text, r.n_chars) for r in texts.collect())
    want = Counter()
    for r in first:
        more = r.mix_fraction > 0 and 2 * r.mix_fraction >= r.mix_size and r.mix_copies < 3
        want[r.doc_id, r.text, r.n_chars] += r.mix_copies + more
    assert copies == +want  # whole texts, each at most three times for each of its rows
    off = Counter()
    for r in first:
        off[r.source] += r.mix_taken
    for (i, t, _), n in copies.items():
        off[next(r.source for r in first if (r.doc_id, r.text) == (i, t))] -= n * len(WORD.findall(t))
    assert all(2 * abs(off[s]) <= max(r.mix_size for r in first if r.source == s) for s in off)


def test_mix_excess_cascades(spark, make_docs):
    rows = [(1, "a", "en", "a"), (2, "b b", "en", "b"), (3, "c " * 50, "en", "c"), (4, "d " * 500, "en", "d"), (5, "", "en", "e")]
    check_mix(mixing.mix(make_docs(rows)).collect(), rows)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None)], [(1, "", "en", "a"), (2, "", "en", "b")]])
def test_mix_without_words(spark, make_docs, rows):
    got = mixing.mix(make_docs(rows)).collect()
    assert len(got) == len(rows) and all(r.mix_taken == 0 for r in got)


# 6: quality rules


def plain_measures(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + j for i in range(len(w) - 2) if windows[w[i], w[i + 1], w[i + 2]] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered), "n_letters": len(re.findall("[A-Za-z]", text)), "n_upper": len(re.findall("[A-Z]", text)),
    }


def test_measures(spark, make_docs, odd_rows):
    rows = odd_rows + [(50, "a b c a b c\nx\n\nx\nx y\n x\n", "en", "a"), (51, "a a a a", "en", "a"), (52, "# ## <b>|</b>\n\n", "en", "a"), (53, "é ü  ", "en", "a")]
    got = quality_rules.measures(make_docs(rows)).collect()
    want = Counter((i, *plain_measures(t).values()) for i, t, *_ in rows)
    assert Counter((r.doc_id, *(r[m] for m in plain_measures(""))) for r in got) == want


def test_binomial_tail():
    from math import comb

    for n, x, p in ((10, 0, 0.1), (30, 4, 0.05), (200, 3, 0.02), (5, 5, 0.3)):
        assert quality_rules.at_most(x, n, p) == pytest.approx(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(x + 1)))


def test_cutoffs_are_certified(spark, make_docs):
    rnd = random.Random(4)
    rows, labels = [], []
    for i in range(6000):
        bad = i % 10 == 0
        words = [f"word{rnd.randrange(10**6)}" + ("###" if bad or rnd.random() < 0.002 else "") for _ in range(60)]
        rows.append((i, " ".join(words), "en" if i % 2 else None, "s"))
        labels.append((i, 0 if bad else 1, 0))
    labels += [(None, 1, 0), (1, None, 0), (3, 1, 0), (3, 1, 0)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality_rules.judge(make_docs(rows), table).collect()
    assert all(not r.kept for r in got if r.doc_id % 10 == 0)
    for lang in ("en", None):
        good = [r for r in got if r.lang == lang and r.doc_id % 10]
        assert sum(not r.kept for r in good) <= quality_rules.RISK * len(good)
    few = quality_rules.judge(make_docs(rows[:200]), table).collect()
    assert all(r.kept != r.base_failed and r.rejected_by in ("", "base") for r in few)  # too few labels for any cutoff


def test_rules_odd_rows(spark, make_docs, odd_rows):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality_rules.judge(make_docs(odd_rows), none).collect()
    assert len(got) == len(odd_rows) and all(r.kept == (not r.base_failed) for r in got)
    assert quality_rules.judge(make_docs([]), none).count() == 0


# 7: license scan


def plain_blocks(text, templates):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    last = max(0, -(-(len(words) - license_scan.BLOCK) // license_scan.STEP))
    out = set()
    for number, (label, template) in enumerate(templates):
        wanted = set(re.findall(r"[a-z0-9\x80-\U0010FFFF]+", template.lower()))
        for b in range(last + 1 if words else 0):
            held = wanted & set(words[b * license_scan.STEP : b * license_scan.STEP + license_scan.BLOCK])
            if wanted and len(held) >= license_scan.CONTAINMENT * len(wanted):
                out.add((b, number, label, len(held)))
    return out


def test_every_block_is_found(spark, make_docs, odd_rows):
    rnd = random.Random(6)
    bank = [w for _, t in license_scan.TEMPLATES for w in t.lower().replace(",", " ").split()] + ["other", "words"] * 30
    rows = odd_rows + [(100 + i, " ".join(rnd.choice(bank) for _ in range(rnd.randrange(0, 400))), "en", "s") for i in range(60)]
    rows += [(200 + i, "x " * i * 9 + t + " y" * 70, "en", "s") for i, (_, t) in enumerate(license_scan.TEMPLATES)]
    _, matches = license_scan.scan_licenses(make_docs(rows))
    got = {(r.doc_id, r.block, r.template, r.label, r.overlap) for r in matches.collect()}
    assert got == {(i, *m) for i, t, *_ in rows for m in plain_blocks(t, license_scan.TEMPLATES)}
    assert {r[0] for r in got} >= set(range(200, 200 + len(license_scan.TEMPLATES)))


def test_long_templates_are_found_at_every_place(spark, make_docs):
    long = " ".join(f"term{i} of" for i in range(91))
    middle = " ".join(f"part{i}" for i in range(60))
    templates = (("long", long), ("middle", middle), *license_scan.TEMPLATES[:1])
    rows = [(i, f"{'x ' * i}{t} {'y ' * 300}", "en", label) for i in range(0, 260, 3) for label, t in templates[:2]]
    rows = [(n, t, lang, label) for n, (_, t, lang, label) in enumerate(rows)] + [(9000, f"x {license_scan.TEMPLATES[0][1]} y", "en", "mit")]
    _, matches = license_scan.scan_licenses(make_docs(rows), templates=templates)
    assert {(r.doc_id, r.label) for r in matches.where("containment = 1").collect()} == {(i, label) for i, _, _, label in rows}


def test_labels_of_odd_rows(spark, make_docs, odd_rows):
    got = license_scan.label_documents(make_docs(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    nine = next(r for r in got if r.doc_id == 9)
    assert (nine.n_base, nine.first_word, nine.last_word, nine.base_labels, nine.score) == (4, 0, 8, "cc-by,reserved", 1.0)
    assert all(r.score == 0 and r.labels == "" and r.first_word is None for r in got if r.doc_id != 9)
    assert license_scan.label_documents(make_docs([])).count() == 0
    assert license_scan.label_documents(make_docs(odd_rows), templates=()).count() == len(odd_rows)


# 1: token counts


def changes(spark, rows):
    return spark.createDataFrame(rows, token_counts.DELTA)


def test_rollup_is_additive_and_idempotent(spark, tmp_path):
    store = token_counts.Rollup(spark, str(tmp_path / "store"))
    assert store.totals().count() == 0
    one = changes(spark, [("a", "en", "v1", 1, 10), ("a", "en", "v1", 1, 10), (None, None, "v1", 1, None)])
    assert store.commit("one", one) and not store.commit("one", one)
    store.commit("two", changes(spark, [("a", "en", "v1", -1, -10), ("a", "en", "v1", 0, 5)]))
    store.commit("empty", changes(spark, []))
    want = {("a", "en", "v1", 1, 15), (None, None, "v1", 1, None)}
    assert {tuple(r) for r in store.totals().collect()} == want
    store.compact()
    assert store.batches() == [] and not store.commit("two", one) and {tuple(r) for r in store.totals().collect()} == want
    store.commit("three", changes(spark, [("a", "en", "v1", -1, -15)]))
    store.compact()
    store.compact()
    assert {tuple(r) for r in store.totals().collect()} == {("a", "en", "v1", 0, 0), (None, None, "v1", 1, None)}
    with pytest.raises(ValueError):
        store.commit("../x", one)


def test_a_batch_whose_writer_died_is_written_anew(spark, tmp_path):
    store = token_counts.Rollup(spark, str(tmp_path / "store"))
    changes(spark, [("a", "en", "v1", 7, 7)]).write.parquet(str(tmp_path / "store" / "batch=one"))
    (tmp_path / "store" / "batch=one" / "_SUCCESS").unlink()
    assert store.totals().count() == 0
    assert store.commit("one", changes(spark, [("a", "en", "v1", 1, 2)]))
    assert [tuple(r) for r in store.totals().collect()] == [("a", "en", "v1", 1, 2)]


def test_events_and_real_counts(spark, make_docs, odd_rows, library):
    docs = token_counts.bpe_counts(make_docs(odd_rows), PATH, PATTERN)
    assert Counter((r.doc_id, r.n_tokens) for r in docs.collect()) == Counter((i, len(library.encode_ordinary(t or ""))) for i, t, *_ in odd_rows)
    got = token_counts.events(docs, "revise", "v", before=F.col("n_tokens"), after=F.lit(None)).agg(F.sum("n_docs"), F.sum("n_tokens")).first()
    assert tuple(got) == (0, -sum(len(library.encode_ordinary(t or "")) for _, t, *_ in odd_rows))
    with pytest.raises(ValueError):
        token_counts.events(docs, "insert", "v", before=F.lit(1))


def test_digests(spark, make_docs):
    from maskloom.llm.queries import bpe_digests

    row = bpe_digests(byte_bpe.round_trip(make_docs([(1, None, None, None)]), PATH, PATTERN), "doc_id").first()
    empty = hashlib.sha256(b"").hexdigest()
    assert tuple(row) == (1, 0, empty, empty)

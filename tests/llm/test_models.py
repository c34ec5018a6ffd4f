"""Language and quality models: against direct computation, and held-out accuracy."""

import math
import random
import re
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from maskloom.llm import language_id, quality_classifier
from maskloom.llm import text as scan

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SF = "/root/testdata/sf0.01"


# 8: language


def packed(words):
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    return np.frombuffer(b"".join(words), np.uint8), offsets


def segmentations(word, vocabulary):
    """Every way to cut a word into pieces."""
    for cuts in product((False, True), repeat=len(word) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(word)]
        parts = [word[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        if all(p in vocabulary for p in parts):
            yield parts


def test_all_segmentations_are_summed():
    pieces = language_id.pieces(PATH)
    number = {p: i for i, p in enumerate(pieces.names)}
    rnd = np.random.default_rng(1)
    model = language_id.normalised(rnd.random((len(pieces.names), 3)))
    words = [b"the", b"a", "été".encode(), b"ingandthe", b"zzzz", b"\xff\xfe"]
    got = language_id.word_scores(pieces, model, *packed(words))
    for w, row in zip(words, got, strict=True):
        want = sum(np.prod([model[number[p]] for p in parts], axis=0) for parts in segmentations(w, number))
        assert row == pytest.approx(np.log(want))


def test_expected_counts_are_posterior_means():
    pieces = language_id.pieces(PATH)
    number = {p: i for i, p in enumerate(pieces.names)}
    model = language_id.normalised(np.random.default_rng(2).random((len(pieces.names), 2)))
    words, lang, count = [b"thing", b"ando", b"thing"], np.array([0, 1, 1]), np.array([3, 1, 2])
    got = language_id.expected(pieces, model, lang, count, *packed(words))[: len(pieces.names)]
    want = np.zeros_like(got)
    for w, k, n in zip(words, lang, count, strict=True):
        weighed = [(parts, math.prod(model[number[p], k] for p in parts)) for parts in segmentations(w, number)]
        total = sum(p for _, p in weighed)
        for parts, p in weighed:
            for piece in parts:
                want[number[piece], k] += n * p / total
    assert got == pytest.approx(want)


def plain_log_score(word, number, logs):
    """Forward algorithm place by place in logarithms, over the whole word and all pieces; ``logs`` is the logarithm of the model."""
    longest, at = 33, [np.zeros(logs.shape[1])]
    for j in range(1, len(word) + 1):
        terms = np.array([at[j - m] + logs[number[word[j - m : j]]] for m in range(1, min(j, longest) + 1) if word[j - m : j] in number])
        top = terms.max(axis=0)
        at.append(top + np.log(np.exp(terms - top).sum(axis=0)))
    return at[-1]


LONG_WORDS = ["ありがとうございました", "достаточно", "ありがとうございます" * 7, "ab" * 20, "ab" * 20 + "c", "x" * 5000, "возможностьполучилось" * 230, "中文" * 9, "é" * 33]


def test_whole_words_and_whole_vocabulary():
    """Words beyond 40 and beyond 4,096 bytes, and pieces of up to 33 bytes."""
    pieces = language_id.pieces(PATH)
    number = {p: i for i, p in enumerate(pieces.names)}
    assert max(pieces.lengths) == 33 and len(pieces.names) > 35_000
    model = language_id.normalised(np.random.default_rng(4).random((len(pieces.names), 2)) ** 8)
    words = [w.encode() for w in LONG_WORDS]
    got = language_id.word_scores(pieces, model, *packed(words))
    for w, row in zip(words, got, strict=True):
        assert row == pytest.approx(plain_log_score(w, number, np.log(model[:-1])), rel=1e-9)


def test_expected_counts_of_long_words():
    """Forward-backward in logarithms agrees with that of short words, and each byte is used once."""
    pieces = language_id.pieces(PATH)
    model = language_id.normalised(np.random.default_rng(5).random((len(pieces.names), 2)))
    n = np.array([len(p) for p in pieces.names])
    for w in ("ありがとうございま", "thingandother", "достаточн"):
        flat = np.frombuffer(w.encode(), np.uint8)
        want = language_id.expected(pieces, model, np.array([1]), np.array([1]), flat, np.array([0, len(flat)]))[: len(n), 1]
        piece, used = language_id.long_expected(pieces, model, 1, flat)
        assert np.bincount(piece, weights=used, minlength=len(n)) == pytest.approx(want)
    for w in LONG_WORDS:
        flat = np.frombuffer(w.encode()[: language_id.FIT_BYTES], np.uint8)
        if len(flat) > language_id.SHORT:
            got = language_id.expected(pieces, model, np.array([0]), np.array([3]), flat, np.array([0, len(flat)]))[: len(n), 0]
            assert got @ n == pytest.approx(3 * len(flat))


def test_words_are_whole_and_cut_in_fitting_only():
    texts = next(scan.chunks(pa.array(["x" * 100 + " ÀÉ", None, "ab"])))
    data, row, start, end = language_id.text_words(texts)
    assert (end - start).tolist() == [100, 4, 2] and row.tolist() == [0, 0, 2]
    assert data[start[1] : end[1]].tobytes().decode() == "àé"
    which, lo, hi = language_id.cut_spans(start, end, 32)
    assert (hi - lo).tolist() == [32, 32, 32, 4, 4, 2] and which.tolist() == [0, 0, 0, 0, 1, 2]


def test_query_against_direct_scores(spark):
    """Every text of the table: the best language and its probability from plain counts of words and the plain forward algorithm."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    names, model = language_id.learn(docs, PATH)
    number = {p: i for i, p in enumerate(language_id.pieces(PATH).names)}
    got = {r.doc_id: r for r in language_id.identify(docs.select("doc_id", "text"), names, model, PATH).collect()}
    known, logs = {}, np.log(model[:-1])
    for r in docs.collect():
        low = "".join(c.lower() if "A" <= c <= "Z" or "À" <= c <= "Þ" and c != "×" else c for c in r.text or "").encode()
        likely = np.zeros(len(names))
        for w in re.findall(rb"[a-z\x80-\xff]+", low):
            if w not in known:
                known[w] = plain_log_score(w, number, logs)
            likely += known[w]
        if not any(c.isalpha() for c in r.text or ""):
            assert got[r.doc_id].lang_pred == "und"
            continue
        assert got[r.doc_id].lang_pred == names[int(likely.argmax())]
        assert got[r.doc_id].score == pytest.approx(1 / np.exp(likely - likely.max()).sum())


@pytest.mark.parametrize("room", [1, 40, 10**6])
def test_the_store_of_words_changes_nothing(monkeypatch, room):
    pieces = language_id.pieces(PATH)
    model = language_id.normalised(np.random.default_rng(6).random((len(pieces.names), 2)))
    monkeypatch.setattr(language_id, "STORE", 24 * room)
    store, rnd = language_id.Scores(2), random.Random(7)
    for _ in range(5):
        words = [rnd.choice([b"the", b"and", b"x" * 50, bytes(rnd.choices(b"abc", k=rnd.randrange(1, 6)))]) for _ in range(60)]
        data, offsets = packed(words)
        got = store.look_up(pieces, model, data, offsets[:-1], offsets[1:])
        assert np.allclose(got, language_id.word_scores(pieces, model, data, offsets)) and len(store.hashes) <= room


def test_held_out_accuracy_on_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, model = language_id.learn(docs, PATH)
    assert np.allclose(model.sum(axis=0), 1)
    got = {r.doc_id: r for r in language_id.identify(docs.select("doc_id", "text"), names, model, PATH).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [i for i, r in got.items() if r.held_out]
    assert len(got) == len(truth) and 0.1 < len(held) / len(got) < 0.3
    assert sum(got[i].lang_pred == truth[i] for i in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_of_odd_rows(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    names, model = language_id.learn(docs, PATH)
    got = language_id.identify(docs, names, model, PATH).collect()
    assert len(got) == len(odd_rows) and set(got[0].asDict()) == {*docs.columns, "held_out", "lang_pred"} - {"text"}
    for r in got:
        assert (r.lang_pred == "und") == (r.doc_id in (3, 4, 5, 10) or (r.doc_id is None and r.lang is None)) and (r.lang_pred != "und" or r.score == 0)
    assert Counter(r.lang_pred for r in language_id.identify(docs, [], np.zeros((0, 0)), PATH).collect()) == {"und": len(odd_rows)}
    assert language_id.learn(make_docs([]), PATH)[0] == []
    assert language_id.identify(make_docs([]), names, model, PATH).count() == 0


def test_folds(spark, make_docs):
    import zlib

    got = make_docs([(i, "x", "en", "s") for i in range(50)] + [(None, "x", "en", "s")]).select("doc_id", language_id.held_out().alias("h")).collect()
    assert all(r.h == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


# 10: quality


def plain_grams(text):
    import re

    tokens = re.findall(r"[0-9a-z\x80-\U0010FFFF]+|[^0-9a-z\x80-\U0010FFFF\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return Counter([(t,) for t in tokens] + [("same",) * 3 if a == b else (a, b) for a, b in zip(tokens, tokens[1:], strict=False)])


def test_grams(odd_rows):
    texts = [t for _, t, *_ in odd_rows] + ["a!! a!!  b b b", "x", "!!"]
    names = {}
    for part in scan.chunks(pa.array(texts)):
        row, bucket = quality_classifier.grams(part)
        for i in range(part.rows):
            want = plain_grams(texts[part.first + i])
            got = Counter(bucket[row == i].tolist())
            assert sum(got.values()) == sum(want.values())
            if len(want) == 1:
                names.setdefault(next(iter(want)), set()).add(next(iter(got)))
    assert all(len(b) == 1 for b in names.values())


def brute_score(rows, labels, seed):
    """The same model on dense counts, in plain Python loops."""
    import hashlib

    good = {i for i in {i for i, *_ in labels} if i is not None and all(q == 1 and not t for j, q, t in labels if j == i)}
    counts, per = np.zeros((2, quality_classifier.BUCKETS)), []
    for i, t, *_ in rows:
        part = next(scan.chunks(pa.array([t])))
        n = np.bincount(quality_classifier.grams(part)[1], minlength=quality_classifier.BUCKETS)
        per.append(n)
        counts[0] += n
        counts[1] += n * (i in good)
    logs = np.log((counts + 1) / (counts.sum(axis=1, keepdims=True) + quality_classifier.BUCKETS))
    weight = [64 * float(n @ (logs[1] - logs[0])) / (n.sum() + 16) for n in per]
    noise = [-math.log(-math.log((int(hashlib.md5(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:12], 16) + 0.5) / 16**12)) for i, *_ in rows]
    least = np.percentile([w for w, (i, *_) in zip(weight, rows, strict=True) if i in good], 100 * (1 - quality_classifier.KEEP))
    k = sum(w >= least - quality_classifier.MARGIN for w in weight)
    best = sorted(range(len(rows)), key=lambda j: -(weight[j] + noise[j]))[:k]
    return weight, set(best)


def corpus(n):
    rnd = random.Random(n)
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        words = [rnd.choice("the of and to in a is that for it was on are as with".split()) + rnd.choice(["", "", "ing", "ed"]) for _ in range(rnd.randrange(5, 200))]
        rows.append((i, " ".join(w + "!!!" if bad else w for w in words), "en", "s"))
        if i % 2:
            labels.append((i, 0 if bad else 1, 0))
    return rows, labels + [(None, 1, 0), (7, 1, 1), (9, None, None)]


def test_resampling_as_brute_force(spark, make_docs):
    rows, labels = corpus(400)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_classifier.score(make_docs(rows), table, seed=3).collect()}
    weight, best = brute_score(rows, labels, 3)
    assert [got[i].log_weight for i, *_ in rows] == pytest.approx(weight)
    assert {i for i, r in got.items() if r.kept} == best
    assert all(got[i].kept for i, *_ in rows if i % 5) and not any(got[i].kept for i, *_ in rows if i % 5 == 0)
    texts = quality_classifier.score(make_docs(rows), table, seed=3, with_text=True).where("kept").collect()
    assert {(r.doc_id, r.text) for r in texts} == {(i, t) for i, t, *_ in rows if i in best}


def test_level_covers_targets_beyond_the_fitted_ones(spark, make_docs, monkeypatch):
    rows, labels = corpus(300)
    monkeypatch.setattr(quality_classifier, "TARGET_ROWS", 12)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality_classifier.score(make_docs(rows), table).collect()
    good = {i for i, q, t in labels if q == 1 and not t and i is not None} - {7}
    least = np.percentile([r.log_weight for r in got if r.doc_id in good], 100 * (1 - quality_classifier.KEEP))
    fitted = {r.c_id for r in quality_classifier._targets(table).collect()}
    sampled = np.percentile([r.log_weight for r in got if r.doc_id in fitted], 100 * (1 - quality_classifier.KEEP))
    count = lambda x: sum(r.log_weight >= x - quality_classifier.MARGIN for r in got)
    assert len(fitted) == 12 and count(least) != count(sampled)
    assert sum(r.kept for r in got) == count(least)


@pytest.mark.parametrize("share", [0.0, 0.002, 0.37, 1.0])
def test_level_is_exact(spark, share):
    rnd = random.Random(2)
    weights = [rnd.choice([1.5, rnd.gauss(0, 50)]) for _ in range(700)]
    table = spark.createDataFrame([(w,) for w in weights], "log_weight double")
    assert quality_classifier.level(table, share) == pytest.approx(np.percentile(weights, 100 * share))


@pytest.mark.parametrize("k", [0, 1, 5, 37, 99, 100])
def test_top_k_is_exact(spark, k):
    rnd = random.Random(k)
    rows = [(i, rnd.choice([0.0, 1.5, rnd.gauss(0, 50)])) for i in range(100)]
    scored = spark.createDataFrame(rows, "doc_id long, score double")
    end = quality_classifier.top_k(scored, k)
    kept = [] if end is None else [r for r in scored.withColumn("tie", quality_classifier.tie_key()).collect() if r.score > end[0] or (r.score == end[0] and r.tie <= end[1])]
    assert len(kept) == k and sorted((r.score for r in kept), reverse=True) == sorted((s for _, s in rows), reverse=True)[:k]


def test_quality_odd_rows(spark, make_docs, odd_rows):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.kept for r in quality_classifier.score(make_docs(odd_rows), none).collect())
    some = spark.createDataFrame([(1, 1, 0), (8, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality_classifier.score(make_docs(odd_rows), some, with_text=True).collect()
    assert len(got) == len(odd_rows) and all(r.log_weight == 0 for r in got if not (r.text or "").strip())
    assert len({(r.log_weight, r.kept) for r in got if r.doc_id == 8}) == 1
    assert quality_classifier.score(make_docs([]), some).count() == 0


def test_labelled_documents_of_the_given_table(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r.doc_id: r.kept for r in quality_classifier.score(spark.read.parquet(f"{SF}/documents.parquet"), labels).collect()}
    rows = labels.collect()
    assert all(kept[r.doc_id] for r in rows if r.quality == 1)
    assert sum(kept[r.doc_id] for r in rows if r.quality == 0) <= 0.05 * sum(r.quality == 0 for r in rows)

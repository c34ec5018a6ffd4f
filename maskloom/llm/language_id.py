"""Language identification (operator 8): unigram models over a fixed public vocabulary, marginalised over segmentations.

Each language has a probability for every vocabulary piece. A word may be cut into pieces in many ways; its probability is the sum over all of
them, found by the forward algorithm. A text's log likelihood is the sum over its words, and its language the one of greatest
likelihood (ties: the smaller name). Words are whole runs of letters, lower-cased in ASCII and Latin-1; pieces are all letter pieces of the vocabulary, of any length,
and all single bytes, so every word has a segmentation. Words of at most ``SHORT`` bytes are scored many at a time; longer ones each by itself, rescaled as the recursion goes on.

Probabilities come from ``ROUNDS`` of expectation maximisation (forward-backward counts) over the words of at most ``FIT_DOCS`` training documents of
each language, first by a hash of the id; in fitting, and only there, runs of more than ``FIT_BYTES`` bytes are cut. Word counts and expected counts are summed by Spark; what
is collected is bounded by languages times pieces. Scoring takes all whole texts.

Memory: texts are scored ``CHUNK`` bytes at a time, and handed on as batches of that size. Blocks of the recursion are sized in bytes (words, length and languages), so
they do not grow with the number of languages; scores of words stay in a store of ``STORE`` bytes, as words come again.

Defined cases: a text that is null or has no letter is ``und`` with score 0; so is every text if nothing can be learned; equal rows are scored alike; a null
id is held out; null languages teach nothing; an empty table gives no rows. Columns named like the added ones are replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskloom.llm import text as scan
from maskloom.session import cut

FOLDS = 5
FIT_DOCS, MAX_LANGUAGES = 3_000, 64
ROUNDS = 3
#: so long a word's probability is still a floating-point number: at least (FLOOR / pieces) ** SHORT
SHORT = 40
FIT_BYTES = 4096
CHUNK, STORE, BLOCK_BYTES = 512 << 10, 8 << 20, 4 << 20
#: part of each language's probability that is spread over all pieces
FLOOR = 0.01
ADDED = ("held_out", "lang_pred", "score")

_LETTER = np.zeros(256, bool)
_LETTER[[*range(97, 123), *range(128, 256)]] = True


def held_out() -> Column:
    """One document of ``FOLDS``, by a checksum of its id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def lowered(data: np.ndarray) -> np.ndarray:
    out = scan.LOWER[data]
    capital = (out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97)
    out[1:][capital] += 0x20
    return out


class Pieces:
    """The vocabulary: all letter pieces, and all single bytes."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            tokens = {base64.b64decode(line.split()[0]).lstrip(b" ") for line in lines}
        inner = _LETTER.tolist()
        self.names = sorted({t for t in tokens if t and all(inner[b] for b in t)} | {bytes([b]) for b in range(256)})
        n = np.fromiter(map(len, self.names), np.int64, len(self.names))
        self.lengths = np.unique(n).tolist()
        end = np.cumsum(n)
        found = scan.span_hash(scan.prefix_hash(np.frombuffer(b"".join(self.names), np.uint8)), end - n, end)
        self.order = np.argsort(found)
        self.hashes = found[self.order]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of pieces; those that are none get the number after the last."""
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        return np.where(self.hashes[at] == hashes, self.order[at], len(self.names))


_loaded: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def text_words(texts: scan.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, row, start, end) of all words of a chunk."""
    data = lowered(texts.data)
    return data, *scan.spans(_LETTER[data], texts.offsets)


def cut_spans(start: np.ndarray, end: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(which, start, end): spans of more than ``size`` bytes in parts."""
    parts = -(-(end - start) // size)
    which = np.repeat(np.arange(len(start)), parts)
    begin = start[which] + (np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)) * size
    return which, begin, np.minimum(begin + size, end[which])


def compact(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some spans put together, and where each begins (one more entry)."""
    n = end - start
    offsets = np.concatenate([[0], np.cumsum(n)])
    return data[np.repeat(start - offsets[:-1], n) + np.arange(offsets[-1])], offsets


def _steps(vocabulary: Pieces, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, int, int, np.ndarray]]:
    """For all places j and all lengths m of pieces: (words that have a piece of m bytes ending at j, j, m, number of the piece)."""
    prefix = scan.prefix_hash(data)
    n = np.diff(offsets)
    order = np.argsort(-n, kind="stable")
    lengths = n[order]
    for j in range(1, int(n.max(initial=0)) + 1):
        active = order[: np.searchsorted(-lengths, -j, "right")]
        end = offsets[active] + j
        for m in vocabulary.lengths:
            if m > j:
                break
            piece = vocabulary.find(scan.span_hash(prefix, end - m, end))
            known = piece < len(vocabulary.names)
            yield active[known], j, m, piece[known]


def blocks(offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Words of similar length, by number: those of at most ``SHORT`` bytes in blocks of about ``BLOCK_BYTES``, at ``width`` bytes for each place of a word."""
    n = np.diff(offsets)
    order = np.argsort(n, kind="stable")
    lengths = n[order]
    short = int(np.searchsorted(lengths, SHORT, "right"))
    room = max(1, BLOCK_BYTES // width)
    lo = 0
    while lo < short:
        some = lengths[lo : min(short, lo + room)]
        hi = lo + max(1, int(np.searchsorted((some + 1) * np.arange(1, len(some) + 1), room, "right")))
        yield order[lo:hi]
        lo = hi


def long_words(offsets: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.diff(offsets) > SHORT)


def ending_pieces(vocabulary: Pieces, data: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """For the places lo + 1 to hi of one word: the numbers of the pieces that end there, the longest first, one column for each length up to the longest."""
    longest = vocabulary.lengths[-1]
    first = max(0, lo - longest)
    prefix = scan.prefix_hash(data[first:hi])
    out = np.full((hi - lo, longest), len(vocabulary.names), np.int64)
    end = np.arange(lo + 1, hi + 1) - first
    for m in vocabulary.lengths:
        fits = np.flatnonzero(end + first >= m)
        out[fits, longest - m] = vocabulary.find(scan.span_hash(prefix, end[fits] - m, end[fits]))
    return out


#: places of a long word between two rescalings
PACE = 8


def long_score(vocabulary: Pieces, model: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Log probability of one word of any length in each language."""
    longest = vocabulary.lengths[-1]
    window = np.zeros((longest + 4096, model.shape[1]))
    window[longest - 1] = 1
    scale = np.zeros(model.shape[1])
    for lo in range(0, len(data), 4096):
        hi = min(lo + 4096, len(data))
        piece = ending_pieces(vocabulary, data, lo, hi)
        for j in range(hi - lo):
            window[longest + j] = (window[j : j + longest] * model[piece[j]]).sum(axis=0)
            if j % PACE == PACE - 1:
                top = window[j + 1 : j + 1 + longest].max(axis=0)
                window[j + 1 : j + 1 + longest] /= top
                scale += np.log(top)
        window[:longest] = window[hi - lo : hi - lo + longest].copy()
    return scale + np.log(window[longest - 1])


def word_scores(vocabulary: Pieces, model: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language; ``model`` has a row for each piece and one of zeros."""
    out = np.empty((len(offsets) - 1, model.shape[1]))
    for words in blocks(offsets, 8 * model.shape[1]):
        flat, own = compact(data, offsets[words], offsets[words + 1])
        n = np.diff(own)
        forward = np.zeros((int(n.max()) + 1, len(words), model.shape[1]))
        forward[0] = 1
        for at, j, m, piece in _steps(vocabulary, flat, own):
            forward[j, at] += forward[j - m, at] * model[piece]
        out[words] = np.log(forward[n, np.arange(len(words))])
    for w in long_words(offsets):
        out[w] = long_score(vocabulary, model, data[offsets[w] : offsets[w + 1]])
    return out


def long_expected(vocabulary: Pieces, model: np.ndarray, lang: int, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pieces, their expected numbers) in one word of more than ``SHORT`` bytes, in logarithms."""
    longest, n = vocabulary.lengths[-1], len(data)
    piece = ending_pieces(vocabulary, data, 0, n)
    with np.errstate(divide="ignore"):
        p = np.log(model[piece, lang])
    forward, backward = np.full(longest + n, -np.inf), np.full(n + longest, -np.inf)
    forward[longest - 1] = backward[n - 1] = 0  # forward[longest - 1 + j], backward[j - 1]: the place after j bytes
    for j in range(n):
        terms = forward[j : j + longest] + p[j]
        top = terms.max()
        forward[longest + j] = top + np.log(np.exp(terms - top).sum())
    # the pieces that begin at a place end at the next ones: a diagonal of the table
    padded = np.vstack([p, np.full((longest, longest), -np.inf)])
    steps = np.arange(longest)
    for j in range(n - 1, 0, -1):
        terms = backward[j : j + longest] + padded[j + steps, longest - 1 - steps]
        top = terms.max()
        backward[j - 1] = top + np.log(np.exp(terms - top).sum())
    before = forward[np.arange(n)[:, None] + steps]
    used = np.exp(before + p + backward[:n, None] - forward[longest + n - 1])
    some = used > 0
    return piece[some], used[some]


def expected(vocabulary: Pieces, model: np.ndarray, lang: np.ndarray, count: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Expected piece counts for each language, by the forward-backward algorithm."""
    total = np.zeros(model.size)
    # a place of a word keeps one entry (word, piece, probability) for each length of piece
    for words in blocks(offsets, 24 * 8):
        flat, own = compact(data, offsets[words], offsets[words + 1])
        n, who = np.diff(own), lang[words]
        places = np.arange(len(words))
        forward = np.zeros((int(n.max()) + 1, len(words)))
        forward[0] = 1
        steps = []
        for at, j, m, piece in _steps(vocabulary, flat, own):
            p = model[piece, who[at]]
            forward[j, at] += forward[j - m, at] * p
            steps.append((at, j, m, piece, p))
        backward = np.zeros_like(forward)
        backward[n, places] = count[words] / forward[n, places]
        for at, j, m, piece, p in reversed(steps):
            use = p * backward[j, at]
            backward[j - m, at] += use
            np.add.at(total, piece * model.shape[1] + who[at], forward[j - m, at] * use)
    for w in long_words(offsets):
        piece, used = long_expected(vocabulary, model, int(lang[w]), data[offsets[w] : offsets[w + 1]])
        np.add.at(total, piece * model.shape[1] + int(lang[w]), used * count[w])
    return total.reshape(model.shape)


def normalised(counts: np.ndarray) -> np.ndarray:
    """Probabilities with the floor, and a last row of zeros."""
    share = counts / np.maximum(counts.sum(axis=0, keepdims=True), 1e-300)
    return np.vstack([(1 - FLOOR) * share + FLOOR / len(counts), np.zeros((1, counts.shape[1]))])


def learn(docs: DataFrame, path: str) -> tuple[list[str], np.ndarray]:
    """(languages, model) from training documents (doc_id, text, lang)."""
    training = docs.where(~held_out() & F.col("lang").isNotNull()).select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    sizes = {r.lang: r["count"] for r in training.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    names = sorted(sizes)
    if not names:
        return [], np.zeros((0, 0))
    # only ids whose hash is below a limit, about twice FIT_DOCS of a language, are ranked
    limits = F.create_map(*[F.lit(x) for n in names for x in (n, min(1.0, 2 * FIT_DOCS / sizes[n]))])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) / float(1 << 31)
    first = Window.partitionBy("lang").orderBy(place, "doc_id")
    low = training.select("doc_id", "lang").where(place < limits[F.col("lang")])
    chosen = low.withColumn("i_rank", F.row_number().over(first)).where(F.col("i_rank") <= FIT_DOCS).select(F.col("doc_id").alias("i_id")).distinct()
    sample = training.join(F.broadcast(chosen), F.col("doc_id") == F.col("i_id"), "left_semi")  # at most FIT_DOCS ids of each language
    number = {n: i for i, n in enumerate(names)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
            for part in scan.chunks(batch.column("text"), CHUNK):
                data, row, start, end = text_words(part)
                which, start, end = cut_spans(start, end, FIT_BYTES)
                lang = langs[part.first : part.first + part.rows][row[which]]
                key, at, n = np.unique(scan.mix(scan.span_hash(scan.prefix_hash(data), start, end) + lang.astype(np.uint64)), return_index=True, return_counts=True)
                flat, offsets = compact(data, start[at], end[at])
                raw, edge = flat.tobytes(), offsets.tolist()
                yield pa.RecordBatch.from_pydict({"lang": lang[at], "word": pa.array([raw[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)], pa.binary()), "n": n})

    words = cut(sample.select("lang", "text").mapInArrow(count, "lang long, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    size = len(pieces(path).names)
    model = normalised(np.ones((size, len(names))))
    for _ in range(ROUNDS):

        def expect(batches: Iterator[pa.RecordBatch], model: np.ndarray = model) -> Iterator[pa.RecordBatch]:
            vocabulary, total = pieces(path), np.zeros((size, len(names)))
            for batch in batches:
                if batch.num_rows:
                    own = batch.column("word").to_pylist()
                    offsets = np.concatenate([[0], np.cumsum([len(w) for w in own])])
                    total += expected(vocabulary, model[:, :], batch.column("lang").to_numpy(), batch.column("n").to_numpy(), np.frombuffer(b"".join(own), np.uint8), offsets)[:size]
            cell = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"cell": cell, "n": total.ravel()[cell]})

        counts = np.zeros(size * len(names))
        for r in words.mapInArrow(expect, "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect():
            counts[r.cell] = r.n
        model = normalised(counts.reshape(size, len(names)))
    return names, model


class Scores:
    """Scores of the words seen lately, by hash, in at most about ``STORE`` bytes."""

    def __init__(self, languages: int):
        self.room = max(1, STORE // (8 * (languages + 1)))
        self.hashes, self.scores = np.zeros(0, np.uint64), np.zeros((0, languages))

    def look_up(self, vocabulary: Pieces, model: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The scores of some words of ``data``; new ones are computed and kept."""
        if not len(start):
            return self.scores[:0]
        lo, hi = int(start[0]), int(end[-1])
        hashes, first, inverse = np.unique(scan.span_hash(scan.prefix_hash(data[lo:hi]), start - lo, end - lo), return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, hashes)
        if len(self.hashes):
            at[at == len(self.hashes)] = 0
            new = self.hashes[at] != hashes
        else:
            new = np.ones(len(hashes), bool)
        out = np.empty((len(hashes), model.shape[1]))
        out[~new] = self.scores[at[~new]]
        flat, offsets = compact(data, start[first[new]], end[first[new]])
        out[new] = word_scores(vocabulary, model, flat, offsets)
        if len(self.hashes) + int(new.sum()) > self.room:
            self.hashes, self.scores = hashes[: self.room], out[: self.room].copy()
        else:
            merged = np.concatenate([self.hashes, hashes[new]])
            order = np.argsort(merged, kind="stable")
            self.hashes, self.scores = merged[order], np.concatenate([self.scores, out[new]])[order]
        return out[inverse]


def has_letter(column: pa.Array, ascii_letters: np.ndarray, high: np.ndarray) -> np.ndarray:
    out = ascii_letters > 0
    for i in np.flatnonzero(~out & (high > 0)):
        out[i] = any(c.isalpha() for c in column[int(i)].as_py())
    return out


def identify(docs: DataFrame, names: list[str], model: np.ndarray, path: str, with_text: bool = False) -> DataFrame:
    """Add ``held_out``, ``lang_pred`` and ``score`` (posterior of the predicted language, all languages equally likely before)."""
    fields = [f for f in docs.schema.fields if f.name not in ADDED and f.name != "text"]
    kept = [f.name for f in fields]
    text_field = [T.StructField("text", T.StringType())] * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Scores(model.shape[1])
        step = max(1024, BLOCK_BYTES // (8 * max(1, model.shape[1])))
        for batch in batches:
            for part in scan.chunks(batch.column("i_text"), CHUNK):
                rows = batch.slice(part.first, part.rows)
                data, row, start, end = text_words(part)
                likely = np.zeros((part.rows, model.shape[1]))
                for lo in range(0, len(row), step) if names else ():
                    some = slice(lo, lo + step)
                    score = store.look_up(pieces(path), model, data, start[some], end[some])
                    for k in range(model.shape[1]):
                        likely[:, k] += np.bincount(row[some], weights=score[:, k], minlength=part.rows)
                place = np.repeat(np.arange(part.rows), np.diff(part.offsets))
                letters, high = (np.bincount(place[flag], minlength=part.rows) for flag in ((data >= 97) & (data <= 122), data >= 128))
                column = rows.column("i_text").fill_null("")
                known = has_letter(column, letters, high) if names else np.zeros(part.rows, bool)
                pred, score = np.full(part.rows, "und", object), np.zeros(part.rows)
                if names:
                    best = likely.argmax(axis=1)
                    odds = np.exp(likely - likely.max(axis=1, keepdims=True))
                    pred[known] = np.array(names, object)[best[known]]
                    score[known] = (1 / odds.sum(axis=1))[known]
                out = {c: rows.column(c) for c in kept} | ({"text": rows.column("i_text")} if with_text else {})
                yield pa.RecordBatch.from_pydict(out | {"lang_pred": pa.array(pred, pa.string()), "score": pa.array(score)})
        scan.release_memory()

    schema = T.StructType([*fields, *text_field, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col("text").cast("string").alias("i_text")).mapInArrow(run, schema)
    return rows.withColumn("held_out", held_out())

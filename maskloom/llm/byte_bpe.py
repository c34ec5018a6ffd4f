"""Byte-level BPE encoding and decoding (operator 9) with DuckDB recursive queries inside each task.

Spark deals out the texts. In a task the distinct pieces of a batch (matches of the public split pattern) become
token-position rows, linked to the next; a recursive query joins neighbouring tokens with the merge table and contracts,
for each piece and round, the leftmost pair of least rank, until no pair is left. Ids go back to text by a join of the id
lists with the vocabulary and an ordered string aggregation, one row per text.

Pieces repeat, so their ids are kept between the batches of a task, in two stores of about ``KEPT`` pieces: when the young one is full it becomes the old one, and
what is met again moves on to the next. The result does not depend on it. At the end of a task the stores and the database are dropped and free memory goes back to
the machine, as workers live on and later tasks, of other operators too, need the room. Nothing is shuffled.

Defined cases: a null or empty text has no ids and decodes to the empty text; equal rows give equal results; all
columns of the input are kept, those named like the added ones are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import functools
import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskloom.llm import text as scan

#: pieces in each of the two stores of a Python worker
KEPT = 150_000
#: characters of text handled together, bytes of new pieces per recursive query
BLOCK_CHARS, PIECE_BYTES = 2_000_000, 125_000
#: A piece takes a round for each contraction, so its cost is quadratic. Pieces of more bytes (unbroken runs, as of letters without
#: a space) are contracted in the same order with a heap instead.
LONG = 512
ADDED = ("ids", "decoded")

#: A row knows the token after it and where that ends, so a round needs no window: the least pair of a piece (rank, places of its two
#: tokens) comes from a hash aggregate, meets the row of its second token, and goes back to the rows of the piece.
ENCODE_SQL = """
WITH RECURSIVE s(piece, pos, tok, after, next_tok, pair, live) AS (
  SELECT piece, pos, tok, (pos + 1)::USMALLINT, next_tok, (merged::BIGINT << 32) | (pos::BIGINT << 16) | (pos + 1), true
  FROM start_rows LEFT JOIN merges ON left_tok = tok AND right_tok = next_tok
  UNION ALL
  SELECT piece, pos, tok, after, next_tok, CASE WHEN touched THEN (merged::BIGINT << 32) | (pos::BIGINT << 16) | after ELSE pair END, live
  FROM (SELECT s.piece, pos, CASE WHEN pos = first THEN made ELSE tok END AS tok, CASE WHEN pos = first THEN far ELSE after END AS after,
               CASE WHEN pos = first THEN far_tok WHEN after = first THEN made ELSE next_tok END AS next_tok,
               pair, coalesce(pos = first OR after = first, false) AS touched, first IS NOT NULL AS live
        FROM s LEFT JOIN (SELECT b.piece, (best >> 32)::INTEGER AS made, ((best >> 16) & 65535)::USMALLINT AS first, q.pos AS second, q.after AS far, q.next_tok AS far_tok
                          FROM (SELECT piece, min(pair) AS best FROM s WHERE pair IS NOT NULL GROUP BY piece) AS b
                          JOIN s AS q ON q.piece = b.piece AND q.pos = (b.best & 65535)::USMALLINT) AS c ON c.piece = s.piece
        WHERE s.live AND (second IS NULL OR pos <> second)) AS p
  LEFT JOIN merges ON left_tok = CASE WHEN touched THEN tok END AND right_tok = next_tok)
SELECT piece, pos, tok FROM s WHERE NOT live ORDER BY piece, pos
"""
DECODE_SQL = """
SELECT list_aggregate(list_transform(ids, lambda i: vocabulary.tokens[i + 1]), 'string_agg', '') AS bytes
FROM id_rows, (SELECT list(token ORDER BY id) AS tokens FROM tokens) AS vocabulary ORDER BY n
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Coder:
    """The merge table in an in-process DuckDB, with the pieces met so far."""

    def __init__(self, path: str, pattern: str):
        import regex

        ranks = read_ranks(path)
        self.split = regex.compile(pattern).findall
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [
            (ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks
        ]
        left, right, merged = (pa.array(x, pa.int32()) for x in zip(*pairs, strict=True))
        self.merges = pa.table({"left_tok": left, "right_tok": right, "merged": merged})
        by_id = sorted((r, t.decode("latin-1")) for t, r in ranks.items())
        if [r for r, _ in by_id] != list(range(len(by_id))):
            raise ValueError("ranks must be 0, 1, 2, ...")
        self.tokens = pa.table({"id": pa.array([r for r, _ in by_id], pa.int32()), "token": [t for _, t in by_id]})
        self.release()

    @functools.cached_property
    def con(self):
        import duckdb

        con = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        for name in ("merges", "tokens"):
            con.register("given", getattr(self, name))
            con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        return con

    @functools.cached_property
    def merged(self) -> dict[tuple[int, int], int]:
        left, right, merged = (self.merges[c].to_pylist() for c in ("left_tok", "right_tok", "merged"))
        return dict(zip(zip(left, right, strict=True), merged, strict=True))

    def release(self) -> None:
        """Drop what was met, and the database; both come back when they are needed."""
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        if "con" in vars(self):
            self.con.close()
            del self.con
        vars(self).pop("merged", None)

    def learn(self, pieces: list[str]) -> None:
        """Encode new pieces, some at a time, and remember their ids as little-endian 32-bit numbers."""
        batch: list[bytes] = []
        size = first = 0
        short = [p for p in pieces if len(p) * 4 <= LONG or len(p.encode()) <= LONG]
        for at, piece in enumerate(short):
            batch.append(piece.encode())
            size += len(batch[-1])
            if size >= PIECE_BYTES or at + 1 == len(short):
                self._encode(short[first : at + 1], batch)
                batch, size, first = [], 0, at + 1
        if len(short) < len(pieces):
            self.known |= {p: self._contract(p.encode()) for p in set(pieces).difference(short)}

    def _contract(self, data: bytes) -> bytes:
        """Leftmost pair of least rank first, for one long piece."""
        toks: list[int | None] = self.byte[np.frombuffer(data, np.uint8)].tolist()
        after, before = [*range(1, len(toks)), -1], list(range(-1, len(toks) - 1))
        heap = [(r, i, i + 1) for i, pair in enumerate(itertools.pairwise(toks)) if (r := self.merged.get(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, j = heapq.heappop(heap)
            if toks[i] is None or after[i] != j or self.merged.get((toks[i], toks[j])) != r:
                continue
            toks[i], toks[j] = r, None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (new := self.merged.get((toks[a], toks[b]))) is not None:
                    heapq.heappush(heap, (new, a, b))
        return np.array([t for t in toks if t is not None], "<u4").tobytes()

    def _encode(self, names: list[str], batch: list[bytes]) -> None:
        n = np.fromiter(map(len, batch), np.int64, len(batch))
        data = np.frombuffer(b"".join(batch), np.uint8)
        end = np.cumsum(n)
        tok, last = self.byte[data], np.zeros(len(data), bool)
        last[end - 1] = True
        start = pa.table({
            "piece": np.repeat(np.arange(len(batch), dtype=np.int32), n), "pos": (np.arange(len(data)) - np.repeat(end - n, n)).astype(np.uint16),
            "tok": tok, "next_tok": pa.array(np.append(tok[1:], np.int32(0)), mask=last),
        })
        self.con.register("start_rows", start)
        out = self.con.sql(ENCODE_SQL).to_arrow_table()
        piece, ids = out["piece"].to_numpy(), out["tok"].to_numpy().astype("<u4")
        ends = np.cumsum(np.bincount(piece, minlength=len(batch)))
        raw, last = ids.tobytes(), 0
        for name, end in zip(names, (ends * 4).tolist(), strict=True):
            self.known[name] = raw[last:end]
            last = end

    def encode(self, texts: list[str]) -> list[bytes]:
        pieces = [self.split(t) for t in texts]
        if len(self.known) > KEPT:
            self.old, self.known = self.known, {}
        new = set().union(*pieces).difference(self.known)
        again = new.intersection(self.old)
        self.known |= {p: self.old[p] for p in again}
        new -= again
        if new:
            self.learn(sorted(new))
        ids = self.known.__getitem__
        return [b"".join(map(ids, p)) for p in pieces]

    def decode(self, coded: list[bytes]) -> list[bytes]:
        flat = pa.array(np.frombuffer(b"".join(coded), "<u4").astype(np.int32))
        ends = np.concatenate([[0], np.cumsum([len(b) // 4 for b in coded])]).astype(np.int32)
        self.con.register("id_rows", pa.table({"n": np.arange(len(coded), dtype=np.int32), "ids": pa.ListArray.from_arrays(pa.array(ends), flat)}))
        return [(t or "").encode("latin-1") for t in self.con.sql(DECODE_SQL).to_arrow_table()["bytes"].to_pylist()]


_coders: dict[tuple[str, str], Coder] = {}


def coder(path: str, pattern: str) -> Coder:
    if (path, pattern) not in _coders:
        _coders[path, pattern] = Coder(path, pattern)
    return _coders[path, pattern]


def _blocks(lengths: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(lengths):
        end, total = at, 0
        while end < len(lengths) and (end == at or total + lengths[end] <= size):
            total += lengths[end]
            end += 1
        yield at, end
        at = end


def _tasks(path: str, pattern: str, kept: list[str], encode: bool, decode: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        try:
            for batch in batches:
                source = batch.column("text" if encode else "ids")
                lengths = np.array([len(x.as_buffer() or b"") if x.is_valid else 0 for x in source], np.int64)
                for at, end in _blocks(lengths, BLOCK_CHARS):
                    part = batch.slice(at, end - at)
                    columns = {c: part.column(c) for c in kept}
                    ids = own.encode([t or "" for t in part.column("text").to_pylist()]) if encode else [i or b"" for i in part.column("ids").to_pylist()]
                    columns["ids"] = pa.array(ids, pa.binary())
                    if decode:
                        columns["decoded"] = pa.array(own.decode(ids), pa.binary())
                    yield pa.RecordBatch.from_pydict(columns)
        finally:
            own.release()
            scan.release_memory()

    return run


def _map(df: DataFrame, path: str, pattern: str, encode: bool, decode: bool) -> DataFrame:
    kept = [f for f in df.schema.fields if f.name not in (ADDED if encode else ("ids", "decoded"))]
    added = [T.StructField("ids", T.BinaryType())] + [T.StructField("decoded", T.BinaryType())] * decode
    rows = df.select(*[F.col(f"`{f.name}`") for f in kept], *([] if encode else ["ids"]))
    return rows.mapInArrow(_tasks(path, pattern, [f.name for f in kept], encode, decode), T.StructType([*kept, *added]))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Add ``ids``: the token ids of ``text`` as little-endian unsigned 32-bit integers."""
    return _map(docs, path, pattern, True, False)


def decode(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Add ``decoded``: the bytes that ``ids`` stand for."""
    return _map(coded, path, pattern, False, True)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Add ``ids`` and what they decode to, in one pass."""
    return _map(docs, path, pattern, True, True)

"""Chat formatting with a prefix tree (operator 4).

A conversation is a path of turns. Conversations that share initial turns share the tokens of these turns: they are emitted once,
depth first, in packs. A pack is a training row: token ids, position ids along each path, a loss mask over assistant texts, and for every
node of the tree its token interval, its parent, and the intervals of its ancestors, to which its tokens may attend. A conversation is a node
of a pack; its own sequence is read back by following the parents.

Each turn has a key that hashes the turns up to it, so sorting by the list of keys is a depth-first order of the tree, at any depth. Conversations are range-partitioned and
sorted by it, with the id last, and each task streams its range into packs of at most ``PACK_TOKENS`` tokens (a longer conversation has a pack of its own).
A shared prefix is repeated only where a pack or a range begins, so a first turn that a third of all conversations share is split among many tasks.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. In texts and roles every ``<``, backslashes, ``|`` gets one more backslash, so no control string can arise; roles
also escape backslashes and line breaks. Control strings have ids of their own, after the vocabulary.

Defined cases: rows of a conversation are ordered by turn (null first), equal turns by role and text; equal rows are separate turns; null
roles and texts are empty; a null conversation id is a conversation like others; an empty table gives no packs; other columns are ignored.
A conversation is assembled in one task: it is the unit of the output.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PACK_TOKENS = 8192
#: bytes of each turn's key that sort the tree; equal keys are told apart by all 16 bytes when packs are filled
KEY = 8
START, END = "<|im_start|>", "<|im_end|>"
PACKS = (
    "ids array<int>, position_ids array<int>, loss_mask array<boolean>, node_start array<int>, node_end array<int>, node_parent array<int>, "
    "ancestors array<array<struct<start:int,end:int>>>, conv_ids array<long>, conv_nodes array<int>"
)


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@cache
def tokenizer(path: str, pattern: str):
    """A public vocabulary with the two control strings after it, and their ids."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    plain = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={START: len(ranks) + 1, END: len(ranks) + 2})
    return plain, {START: len(ranks) + 1, END: len(ranks) + 2}


@dataclass
class Pack:
    """One pack under construction; ``path`` holds (key, node) of the branch that is open."""

    ids: list[int] = field(default_factory=list)
    positions: list[int] = field(default_factory=list)
    loss: list[bool] = field(default_factory=list)
    start: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    convs: list[int | None] = field(default_factory=list)
    nodes: list[int] = field(default_factory=list)
    path: list[tuple[bytes, int]] = field(default_factory=list)

    def shared(self, keys: list[bytes]) -> int:
        n = 0
        while n < len(keys) and n < len(self.path) and self.path[n][0] == keys[n]:
            n += 1
        return n

    def add(self, conv: int | None, keys: list[bytes], turns: list[tuple[list[int], list[bool]]]) -> None:
        n = self.shared(keys)
        del self.path[n:]
        at = self.positions[self.end[self.path[-1][1]] - 1] + 1 if self.path else 0
        for key, (ids, loss) in zip(keys[n:], turns[n:], strict=True):
            self.parent.append(self.path[-1][1] if self.path else -1)
            self.start.append(len(self.ids))
            self.ids += ids
            self.positions += range(at, at + len(ids))
            self.loss += loss
            self.end.append(len(self.ids))
            self.path.append((key, len(self.start) - 1))
            at += len(ids)
        self.convs.append(conv)
        self.nodes.append(self.path[-1][1])

    def row(self) -> dict:
        above: list[list[dict]] = []
        for p in self.parent:
            # neighbouring intervals of a branch are joined
            own = [dict(x) for x in above[p]] if p >= 0 else []
            if p >= 0:
                if own and own[-1]["end"] == self.start[p]:
                    own[-1]["end"] = self.end[p]
                else:
                    own.append({"start": self.start[p], "end": self.end[p]})
            above.append(own)
        return {
            "ids": self.ids, "position_ids": self.positions, "loss_mask": self.loss, "node_start": self.start, "node_end": self.end, "node_parent": self.parent,
            "ancestors": above, "conv_ids": self.convs, "conv_nodes": self.nodes,
        }


def turn_tokens(role: str, text: str, coder) -> tuple[list[int], list[bool]]:
    plain, control = coder
    head = [control[START], *plain.encode_ordinary(escape_role(role) + "\n")]
    body = plain.encode_ordinary(escape(text))
    tail = [control[END], *plain.encode_ordinary("\n")]
    return head + body + tail, [False] * len(head) + [role == "assistant"] * len(body) + [False] * len(tail)


def turn_keys(turns: list[tuple[str, str]]) -> list[bytes]:
    """For each turn a hash of it and all before."""
    out, last = [], b""
    for role, text in turns:
        h = hashlib.blake2b(last, digest_size=16)
        for part in (role.encode(), text.encode()):
            h.update(len(part).to_bytes(8, "little"))
            h.update(part)
        last = h.digest()
        out.append(last)
    return out


CONVERSATION = "conv_id long, turns array<struct<turn:long,role:string,text:string>>"


def conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation, its turns in order."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))


PATHED = CONVERSATION + ", path binary"


def with_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add ``path``, the first ``KEY`` bytes of all turn keys put together: sorted by it, conversations stand in a depth-first order of their tree."""
    for batch in batches:
        paths = [b"".join(k[:KEY] for k in turn_keys([(t["role"], t["text"]) for t in turns])) for turns in batch.column("turns").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(paths, pa.binary())], names=[*batch.schema.names, "path"])


def pack(rows: DataFrame, path: str, pattern: str, pack_tokens: int = PACK_TOKENS) -> DataFrame:
    """Packs of all conversations of ``rows`` (conv_id, turn, role, text)."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = conversations(rows).mapInArrow(with_paths, PATHED)
    dealt = keyed.repartitionByRange(n, "path", "conv_id").sortWithinPartitions("path", "conv_id").select("conv_id", "turns")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, open_pack = tokenizer(path, pattern), Pack()
        for batch in batches:
            for conv, turns in zip(batch.column("conv_id").to_pylist(), batch.column("turns").to_pylist(), strict=True):
                own = [(t["role"], t["text"]) for t in turns]
                keys = turn_keys(own)
                n = open_pack.shared(keys)
                coded = [([], [])] * n + [turn_tokens(r, t, coder) for r, t in own[n:]]
                if open_pack.convs and len(open_pack.ids) + sum(len(ids) for ids, _ in coded) > pack_tokens:
                    yield _batch(open_pack)
                    open_pack = Pack()
                    coded = [turn_tokens(r, t, coder) for r, t in own]
                open_pack.add(conv, keys, coded)
        if open_pack.convs:
            yield _batch(open_pack)

    return dealt.mapInArrow(run, PACKS)


_INTERVAL = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_INTS = pa.list_(pa.int32())
_SCHEMA = pa.schema([
    ("ids", _INTS), ("position_ids", _INTS), ("loss_mask", pa.list_(pa.bool_())), ("node_start", _INTS), ("node_end", _INTS), ("node_parent", _INTS),
    ("ancestors", pa.list_(pa.list_(_INTERVAL))), ("conv_ids", pa.list_(pa.int64())), ("conv_nodes", _INTS),
])


def _batch(done: Pack) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([done.row()], schema=_SCHEMA)


READ = (
    "conv_id long, turns array<struct<role:string,text:string>>, formatted string, loss_text string, tree_tokens int, path_tokens int"
)


def read_back(packs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Each conversation from its pack: turns, the formatted string, and the unescaped text under the loss mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, control = tokenizer(path, pattern)
        for batch in batches:
            for p in batch.to_pylist():
                out: dict[str, list] = {k: [] for k in ("conv_id", "turns", "formatted", "loss_text", "tree_tokens", "path_tokens")}
                for conv, node in zip(p["conv_ids"], p["conv_nodes"], strict=True):
                    spans = [(a["start"], a["end"]) for a in p["ancestors"][node]] + [(p["node_start"][node], p["node_end"][node])]
                    ids = [i for a, b in spans for i in p["ids"][a:b]]
                    mask = [m for a, b in spans for m in p["loss_mask"][a:b]]
                    if [x for a, b in spans for x in p["position_ids"][a:b]] != list(range(len(ids))):
                        raise ValueError("positions of a path must count from 0")
                    out["formatted"].append(coder.decode(ids))
                    turns, learned, at = [], [], 0
                    while at < len(ids):
                        end = ids.index(control[END], at)
                        role, _, text = coder.decode(ids[at + 1 : end]).partition("\n")
                        turns.append({"role": unescape_role(role), "text": unescape(text)})
                        learned.append(unescape(coder.decode([i for i, m in zip(ids[at:end], mask[at:end], strict=True) if m])))
                        at = end + 1
                        while at < len(ids) and ids[at] != control[START]:
                            at += 1
                    for key, value in (("conv_id", conv), ("turns", turns), ("loss_text", "".join(learned)), ("tree_tokens", len(p["ids"])), ("path_tokens", len(ids))):
                        out[key].append(value)
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                    ("conv_id", pa.int64()), ("turns", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))), ("formatted", pa.string()),
                    ("loss_text", pa.string()), ("tree_tokens", pa.int32()), ("path_tokens", pa.int32())]))

    return packs.mapInArrow(run, READ)

"""License scan (operator 7): an exact set-similarity join of text blocks with license templates.

A template is a set of words. A block is ``BLOCK`` consecutive words of a text, one every ``STEP`` words, so a passage of up to
``BLOCK - STEP`` words lies whole in some block. A template of more words has blocks of its own grid: the step doubles until it is no less than the template's
words, and a block is two steps. A block matches a template if it holds at least ``CONTAINMENT`` of the template's words.

The join is exact and uses three filters over one global order of the template words, rarest first by their counts in the corpus:
* prefix: a match must share one of the ``len - need + 1`` rarest words of the template;
* length: a block with fewer than ``need`` template words cannot match;
* positions: a shared word at place i of the template and j of the block leaves at most ``min`` of what follows in both.
The first pass counts template words in the corpus. The second makes a row of every block that holds a prefix word: its
template words in global order. These rows are joined with the prefix index on the word. The templates are a parameter; their words are
collected (at most ``MAX_TEMPLATE_WORDS``, checked), never anything that grows with the corpus.

Base labels are exact phrases; they are found in the same pass.

Defined cases: a null or empty text has no words, no labels and score 0; equal rows get equal results; rows with the same id share their
blocks' labels; a null id is an id like others; an empty table gives no rows; templates without words are left out.
Columns named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskloom.functions.ranking import null_safe_join
from maskloom.llm import text as scan
from maskloom.session import cut

BLOCK, STEP = 64, 32
CONTAINMENT = 0.8
MAX_TEMPLATE_WORDS = 100_000
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: opening sentences of public licenses, each short enough to lie whole in a block
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software)"),
    ("mit", "Released under the MIT License"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
ADDED = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def hashed(texts: list[str]) -> list[np.ndarray]:
    """Word hashes of each text."""
    column = pa.array(texts, pa.large_string())
    out: list[np.ndarray] = []
    for part in scan.chunks(column):
        w = scan.words(part, scan.NOT_WORD, lower=True)
        out += np.split(w.hash, np.cumsum(w.per_row)[:-1])
    return out


def _find(w: scan.Words, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the word in the chunk, index in the sorted vocabulary) of all words of the vocabulary."""
    at = np.searchsorted(vocabulary, w.hash)
    at[at == len(vocabulary)] = 0
    hit = np.flatnonzero(vocabulary[at] == w.hash) if len(vocabulary) else np.zeros(0, np.int64)
    return hit, at[hit]


def count_words(docs: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """How often each vocabulary word occurs in the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for part in scan.chunks(batch.column(0)):
                total += np.bincount(_find(scan.words(part, scan.NOT_WORD, True), vocabulary)[1], minlength=len(vocabulary))
        yield pa.RecordBatch.from_pydict({"word": np.flatnonzero(total), "n": total[total > 0]})

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    out = np.zeros(len(vocabulary), np.int64)
    for row in found.collect():
        out[row.word] = row.n
    return out


def _phrases(w: scan.Words, phrases: list[np.ndarray]) -> list[np.ndarray]:
    """Places (index in the chunk) where the words of each phrase stand consecutively in one row."""
    found = []
    for phrase in phrases:
        at = np.flatnonzero(w.hash == phrase[0])
        at = at[at + len(phrase) <= len(w.hash)]
        for j, h in enumerate(phrase[1:], 1):
            at = at[(w.hash[at + j] == h) & (w.row[at + j] == w.row[at])]
        found.append(at)
    return found


def step_of(words: int) -> int:
    """The step of the grid in which a passage of so many words lies whole in a block of two steps."""
    step = STEP
    while step < words:
        step *= 2
    return step


def _blocks(w: scan.Words, vocabulary: np.ndarray, order: np.ndarray, prefixes: dict[int, np.ndarray]) -> list[list[tuple[int, int, list[int]]]]:
    """For each row the blocks of each grid that hold a prefix word of its templates: (step, block, template words as places in the global order)."""
    out: list[list[tuple[int, int, list[int]]]] = [[] for _ in w.per_row]
    for step, prefix in prefixes.items():
        _blocks_of(out, w, vocabulary, order, prefix, step)
    return out


def _blocks_of(out, w, vocabulary, order, prefix, step):
    block_words = BLOCK // STEP * step
    at, word = _find(w, vocabulary)
    if not len(at):
        return
    place = order[word]
    pos = at - w.first_of_row()[w.row[at]]
    last = np.maximum(0, -(-(w.per_row[w.row[at]] - block_words) // step))  # the last block ends with the text
    rows, blocks, places = [], [], []
    for back in range(block_words // step):
        block = pos // step - back
        ok = (block >= 0) & (block <= last)
        rows.append(w.row[at][ok])
        blocks.append(block[ok])
        places.append(place[ok])
    row, block, place = np.concatenate(rows), np.concatenate(blocks), np.concatenate(places)
    sort = np.lexsort((place, block, row))
    row, block, place = row[sort], block[sort], place[sort]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (block[1:] != block[:-1])
    begin = np.flatnonzero(new)
    held = np.add.reduceat(prefix[place].astype(np.int64), begin)
    end = np.append(begin[1:], len(row))
    for i in np.flatnonzero(held):
        out[row[begin[i]]].append((step, int(block[begin[i]]), np.unique(place[begin[i] : end[i]]).tolist()))


def scan_licenses(docs: DataFrame, templates=TEMPLATES, phrases: dict[str, str] = PHRASES, containment: float = CONTAINMENT) -> tuple[DataFrame, DataFrame]:
    """(documents without their text, with word and phrase figures; matches of blocks with templates).

    Matches: doc_id, block (its first word is ``step * block``), template (its number), label, overlap, containment, step (of the template's grid, ``STEP`` up to as many words).
    """
    spark = docs.sparkSession
    sets = [(label, np.unique(h), step_of(len(h))) for (label, _), h in zip(templates, hashed([t for _, t in templates]), strict=True) if len(h)]
    vocabulary = np.unique(np.concatenate([h for _, h, _ in sets])) if sets else np.zeros(0, np.uint64)
    if len(vocabulary) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates have {len(vocabulary)} different words; at most {MAX_TEMPLATE_WORDS} are allowed")
    order = np.empty(len(vocabulary), np.int64)
    order[np.argsort(count_words(docs, vocabulary), kind="stable")] = np.arange(len(vocabulary))
    index, prefix = [], {step: np.zeros(len(vocabulary), bool) for step in sorted({step for *_, step in sets})}
    for number, (label, words, step) in enumerate(sets):
        places = np.sort(order[np.searchsorted(vocabulary, words)]).tolist()
        need = int(np.ceil(containment * len(places) - 1e-9))
        for i, place in enumerate(places[: len(places) - need + 1]):
            prefix[step][place] = True
            index.append((step, place, i, number, label, need, places))
    phrase_words = hashed(list(phrases))
    names = list(phrases.values())
    kept = [f for f in docs.schema.fields if f.name != "text" and f.name not in (*ADDED, "l_blocks")]
    keep = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in scan.chunks(batch.column("text")):
                w = scan.words(part, scan.NOT_WORD, lower=True)
                n_base = np.zeros(part.rows, np.int64)
                first, last = np.full(part.rows, np.iinfo(np.int64).max), np.full(part.rows, -1)
                labels: list[set[str]] = [set() for _ in range(part.rows)]
                begin = w.first_of_row()
                for name, at in zip(names, _phrases(w, phrase_words), strict=True):
                    row = w.row[at]
                    np.add.at(n_base, row, 1)
                    np.minimum.at(first, row, at - begin[row])
                    np.maximum.at(last, row, at - begin[row])
                    for r in np.unique(row):
                        labels[r].add(name)
                part_rows = batch.slice(part.first, part.rows)
                yield pa.RecordBatch.from_pydict({n: part_rows.column(n) for n in keep} | {
                    "n_words": pa.array(w.per_row, pa.int64()), "n_base": pa.array(n_base),
                    "first_word": pa.array(first, pa.int64(), mask=n_base == 0), "last_word": pa.array(last, pa.int64(), mask=n_base == 0),
                    "base_labels": pa.array([",".join(sorted(x)) for x in labels]),
                    "l_blocks": pa.array([[{"step": s, "block": b, "places": p} for s, b, p in x] for x in _blocks(w, vocabulary, order, prefix)],
                                         pa.list_(pa.struct([("step", pa.int64()), ("block", pa.int64()), ("places", pa.list_(pa.int64()))]))),
                })

    schema = T.StructType([*kept, *T.StructType.fromDDL(
        "n_words long, n_base long, first_word long, last_word long, base_labels string, l_blocks array<struct<step:long,block:long,places:array<long>>>").fields])
    rows = cut(docs.select(*[F.col(f"`{n}`") for n in keep], F.col("text").cast("string").alias("text")).mapInArrow(run, schema))
    held = rows.select("doc_id", F.explode("l_blocks").alias("b")).select("doc_id", "b.step", "b.block", "b.places")
    tokens = held.select("doc_id", "step", "block", "places", F.posexplode("places").alias("j", "place"))
    prefixes = spark.createDataFrame(index, "step long, place long, i int, template int, label string, need int, t_places array<long>")
    room = 1 + F.least(F.size("t_places") - F.col("i") - 1, F.size("places") - F.col("j") - 1)
    # an earlier shared place of both was counted when it was the prefix word itself
    candidates = tokens.join(prefixes, ["step", "place"]).where(F.size("places") >= F.col("need")).withColumn(
        "before", F.size(F.array_intersect(F.slice("places", F.lit(1), F.col("j")), F.slice("t_places", F.lit(1), F.col("i")))))
    overlap = F.size(F.array_intersect("places", "t_places"))
    matches = candidates.where((F.col("before") == 0) & (room >= F.col("need"))).withColumn("overlap", overlap).where(F.col("overlap") >= F.col("need"))
    return rows.drop("l_blocks"), matches.select("doc_id", "block", "template", "label", "overlap", (F.col("overlap") / F.size("t_places")).alias("containment"), "step")


def label_documents(docs: DataFrame, **options) -> DataFrame:
    """One row per document: its figures, base labels, all labels, and ``score``: the best containment, 1 with a base label."""
    rows, matches = scan_licenses(docs, **options)
    found = matches.groupBy("doc_id").agg(F.collect_set("label").alias("l_found"), F.max("containment").alias("l_best"))
    joined = null_safe_join(rows, found, ["doc_id"], "left")
    base = F.filter(F.split("base_labels", ","), lambda x: x != "")
    every = F.array_sort(F.array_distinct(F.concat(base, F.coalesce("l_found", F.array().cast("array<string>")))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("l_best", F.lit(0.0)))
    return joined.withColumn("labels", F.array_join(every, ",")).withColumn("score", score).drop("l_found", "l_best")

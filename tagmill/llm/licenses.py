"""License notices found by diagonal voting.

Every run of ``WIDTH`` words of every text is hashed and joined with the same runs of the
notice templates. A match at word p of a text and word t of a template votes for the
diagonal p - t; votes are summed by diagonal, neighbouring diagonals are merged (words put
in or left out move a notice from one to the next), and what gathered enough votes is
verified against the words of the text.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmill.llm.common import staged
from tagmill.llm.text import WordHashes, mix, pieces
from tagmill.session import broadcast_if_small

# Words of a run, words by which diagonals may differ and still be one place, share of a template's runs that must
# vote and share of its words that must stand in the place in order.
WIDTH, DRIFT, LEAST_VOTES, LEAST_WORDS = 3, 8, 0.3, 0.9
# Words are runs of digits, lower-cased letters and everything beyond ASCII.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

# Phrases whose places always count, with their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices and opening paragraphs of public licenses, with the labels they give.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "Released under the MIT License."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)
# The conditions of the six Creative Commons licenses, from which their two usual notices follow.
CONDITIONS = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
for _name in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND"):
    _long = "-".join(CONDITIONS[c] for c in _name.split("-"))
    TEMPLATES += ((f"cc-{_name.lower()}", f"Licensed under CC {_name} 4.0."),
                  (f"cc-{_name.lower()}", f"This work is licensed under a Creative Commons {_long} 4.0 International License."))

READ = "doc_id bigint, digest binary, n_words bigint, n_base bigint, first_word bigint, last_word bigint, phrases array<string>"
RUNS = "doc_id bigint, digest binary, start bigint, runs array<bigint>"
CHECKED = "doc_id bigint, digest binary, label string, first bigint, last bigint, share double"

Templates = tuple[tuple[str, str], ...]


def windows(data: bytes | None, overlap: int) -> Iterator[tuple[int, int, list[bytes]]]:
    """Number of the first word, words seen before, and words of bounded parts of a text; parts share ``overlap`` words."""
    first, kept = 0, []
    for part in pieces((data or b"").translate(WORD_BYTES)):
        words = kept + part.split()
        yield first, len(kept), words
        kept = words[max(0, len(words) - overlap):]
        first += len(words) - len(kept)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split()


def runs_of(words: list[bytes], known: WordHashes) -> np.ndarray:
    """64-bit hashes of the runs of ``WIDTH`` words, by place."""
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    out = np.zeros(max(0, len(words) - WIDTH + 1), np.uint64)
    for i in range(WIDTH):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + len(out)] + np.uint64(1))
    return out.view(np.int64)


def places_of(words: list[bytes], phrase: list[bytes]) -> Iterator[int]:
    """Where the words of a phrase stand consecutively."""
    at = -1
    for _ in range(words.count(phrase[0])):
        at = words.index(phrase[0], at + 1)
        if words[at:at + len(phrase)] == phrase:
            yield at


def common_words(words: list[bytes], template: list[bytes]) -> int:
    """Length of the longest common subsequence, with one bit per word of the template."""
    bits: dict[bytes, int] = {}
    for i, word in enumerate(template):
        bits[word] = bits.get(word, 0) | 1 << i
    free = every = (1 << len(template)) - 1
    for word in words:
        hit = free & bits.get(word, 0)
        free = ((free + hit) | (free - hit)) & every
    return len(template) - free.bit_count()


def _texts(docs: DataFrame) -> DataFrame:
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary").alias("data"), digest.alias("digest"))


def base_places(docs: DataFrame, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """Words and phrase places of every row."""
    wanted = [(phrase.encode().split(), label) for phrase, label in phrases.items()]
    overlap = max((len(p) for p, _ in wanted), default=1) - 1

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column("data"):
                total, count, low, high, labels = 0, 0, None, None, set()
                for first, seen, words in windows(value.as_py(), overlap):
                    total = first + len(words)
                    for phrase, label in wanted:
                        for at in places_of(words, phrase):
                            if at + len(phrase) > seen:
                                count += 1
                                low, high = min(first + at, low if count > 1 else first + at), max(first + at, high or 0)
                                labels.add(label)
                rows.append((total, count, low, high, sorted(labels)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"),
                                              *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                                             ["doc_id", "digest", "n_words", "n_base", "first_word", "last_word", "phrases"])

    return _texts(docs).mapInArrow(read, READ)


def run_hashes(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, p, run``: the hash of every run of words of every text and the word it starts at."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            at, starts, runs = [], [], []
            for i, value in enumerate(batch.column("data")):
                for first, _, words in windows(value.as_py(), WIDTH - 1):
                    at.append(i)
                    starts.append(first)
                    runs.append(runs_of(words, known))
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in runs])]), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, np.int64), *runs])))
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(rows), batch.column("digest").take(rows),
                                              pa.array(starts, pa.int64()), lists], ["doc_id", "digest", "start", "runs"])

    parts = _texts(docs).mapInArrow(read, RUNS)
    return (parts.select("doc_id", "digest", "start", F.posexplode("runs").alias("i", "run"))
            .select("doc_id", "digest", (F.col("start") + F.col("i")).alias("p"), "run"))


def candidates(docs: DataFrame, templates: Templates = TEMPLATES) -> DataFrame:
    """``doc_id, digest, template, first, last``: word ranges (ends included) whose merged diagonals gathered enough votes."""
    known, rows, need = WordHashes(), [], []
    for number, (_, text) in enumerate(templates):
        runs = runs_of(words_of(text), known)
        rows += [(int(h), number, at) for at, h in enumerate(runs)]
        need.append((number, max(1, math.ceil(LEAST_VOTES * len(runs)))))
    spark = docs.sparkSession
    places = broadcast_if_small(spark.createDataFrame(rows, "run bigint, template int, at int"))
    needed = broadcast_if_small(spark.createDataFrame(need, "template int, need int"))
    # Rows that repeat vote once.
    votes = run_hashes(docs).join(places, "run").select("doc_id", "digest", "template", "at", "p").distinct()
    diagonals = (votes.groupBy("doc_id", "digest", "template", (F.col("p") - F.col("at")).alias("diagonal"))
                 .agg(F.count("*").alias("votes"), F.min("p").alias("first"), F.max("p").alias("last")))
    # A diagonal counts in its own band and the one before, so two within DRIFT of each other share a band, and by itself:
    # notices that follow one another closely must not only be seen as one.
    band = F.floor(F.col("diagonal") / DRIFT)
    alone = F.lit(None).cast("bigint")
    bands = F.array(F.struct((band - 1).alias("band"), alone.alias("own")), F.struct(band.alias("band"), alone.alias("own")),
                    F.struct(alone.alias("band"), F.col("diagonal").alias("own")))
    merged = (diagonals.withColumn("band", F.explode(bands))
              .groupBy("doc_id", "digest", "template", "band")
              .agg(F.sum("votes").alias("votes"), F.min("first").alias("first"), (F.max("last") + WIDTH - 1).alias("last")))
    return (merged.join(needed, "template").filter("votes >= need")
            .select("doc_id", "digest", "template", "first", "last").distinct())


def settle(found: list[tuple[int, str, int, int, float]]) -> list[tuple[str, int, int, float]]:
    """Of (words, label, first, last, share) that overlap the one with the most words in common stays; ties go to the
    higher share, then to the earlier label and place."""
    taken: list[tuple[str, int, int, float]] = []
    for _, label, first, last, share in sorted(found, key=lambda x: (-x[0], -x[4], x[1], x[2], x[3])):
        i = bisect.bisect_left(taken, first, key=lambda t: t[2])
        if i == len(taken) or taken[i][1] > last:
            taken.insert(i, (label, first, last, share))
    return taken


def verified(docs: DataFrame, places: DataFrame, templates: Templates = TEMPLATES) -> DataFrame:
    """``doc_id, digest, label, first, last, share`` of the places that hold the words of their template in order.

    The places go to the texts if they are few; else only texts and places of the same key meet in a join.
    """
    wanted = [(label, words_of(text)) for label, text in templates]
    widest = max((len(t) for _, t in wanted), default=0) + 5 * DRIFT + WIDTH
    by_text = places.groupBy(F.col("doc_id").alias("d"), F.col("digest").alias("g")).agg(
        F.collect_set(F.struct("template", "first", "last")).alias("places"))

    def holds(place: dict, first: int, words: list[bytes]) -> Iterator[tuple[int, str, int, int, float]]:
        label, template = wanted[place["template"]]
        common = common_words(words[max(0, place["first"] - DRIFT - first):place["last"] + 1 + DRIFT - first], template)
        share = common / max(len(template), place["last"] + 1 - place["first"])
        if share >= LEAST_WORDS:
            yield common, label, place["first"], place["last"], share

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, digest, data, rest in zip(*batch.columns, strict=True):
                rest, found, first, words = rest.as_py(), [], 0, []
                for first, _, words in windows(data.as_py(), widest):
                    whole = [p for p in rest if p["last"] + DRIFT < first + len(words)]
                    rest = [p for p in rest if p["last"] + DRIFT >= first + len(words)]
                    found += [x for p in whole for x in holds(p, first, words)]
                found += [x for p in rest for x in holds(p, first, words)]
                out += [(doc.as_py(), digest.as_py(), *x) for x in settle(found)]
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             ["doc_id", "digest", "label", "first", "last", "share"])

    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("digest") == F.col("g"))
    return (_texts(docs).join(broadcast_if_small(by_text), same).select("doc_id", "digest", "data", "places")
            .mapInArrow(check, CHECKED))


def find(docs: DataFrame, templates: Templates = TEMPLATES) -> DataFrame:
    """``doc_id, digest, label, first, last, share``: the verified notices of every text (word numbers, ends included)."""
    return verified(docs, staged(candidates(docs, templates), "notices"), templates)


def scan(docs: DataFrame, templates: Templates = TEMPLATES, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """License phrases and notices of every row of ``docs`` (doc_id, text).

    ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, notices``. ``labels`` joins those of
    the phrases and of the notices; without any it is empty. ``score`` is 1 with a phrase, else the best share of words
    that a notice has in common with its template, else 0. ``notices`` are label, first and last word, and share.

    Null and empty texts have no words. Rows that repeat give equal rows; rows with one id and different texts, and rows
    without an id, are judged each by its own text. Of notices that overlap the longest stays, ties go to the higher share,
    then the earlier label. Texts of any length are read in bounded parts. An empty table gives no rows; other columns
    are ignored. Templates of fewer than ``WIDTH`` words find nothing.
    """
    found = find(docs, templates).groupBy(F.col("doc_id").alias("d"), F.col("digest").alias("g")).agg(
        F.sort_array(F.collect_set(F.struct("first", "last", "label", "share"))).alias("notices"))
    found = broadcast_if_small(staged(found, "notices"))
    rows = base_places(docs, phrases)
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("digest") == F.col("g")), "left")
    labels = F.array_sort(F.array_union("phrases", F.coalesce(F.col("notices.label"), F.array().cast("array<string>"))))
    best = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max("notices.share"), F.lit(0.0)))
    return joined.select("doc_id", "n_words", "n_base", "first_word", "last_word", _joined(F.col("phrases")).alias("base_labels"),
                         _joined(labels).alias("labels"), best.alias("score"), "notices")


def _joined(labels: Column) -> Column:
    return F.array_join(labels, ",")

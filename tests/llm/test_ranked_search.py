"""Ranked search against brute force."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import types as T

from tagmill.llm import search, text

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("score", T.StringType())])


def terms(value):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in value or ""))


def brute(docs, items, k=10):
    """Every row of the answer, from every document and every item."""
    bags = [(i, collections.Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(1 for _, b in bags if b), sum(b.total() for _, b in bags)
    held = collections.Counter(t for _, b in bags for t in b)
    out = []
    for item, value in items:
        scored = []
        for doc, bag in bags:
            m = 25 + 75 * bag.total() * n_docs // max(n_terms, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
                        for t in terms(value) if t in bag)
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if unknown else doc, -score) for rank, (score, unknown, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture
def items_of(spark):
    return lambda rows: spark.createDataFrame([(i, t, "x") for i, t in rows], ITEMS)


def answer(docs, items, **settings):
    return sorted(map(tuple, search.search(docs, items, **settings).collect()), key=str)


def case(seed, many=400):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(150)] + ["Été", "ÉTÉ", "été", "漢字", "3"]
    rare = [r.choice(words) for _ in range(40)]
    docs = [(i, " ".join(r.choice(words if r.random() < 0.7 else rare[:6]) for _ in range(r.randint(0, 30)))) for i in range(many)]
    docs += [(1000, None), (1001, ""), (1002, "?! "), (None, "w1 w2 w3"), (None, "w1 w2 w3"), (7, "w1, W2-w3"), (7, "w1, W2-w3"), (2000, "w5 " * 3000)]
    items = [(i, " ".join(r.choice(words) for _ in range(r.randint(1, 12)))) for i in range(20)]
    return docs, items + [(50, " ".join(words)), (51, None), (52, "!"), (53, "nowhere"), (54, "w1 w1 w2"), (54, "w1 w1 w2"), (None, "w3")]


def test_equals_brute_force(docs_of, items_of):
    docs, items = case(1)
    assert answer(docs_of(docs), items_of(items)) == brute(docs, items)


def test_small_blocks_parts_and_pieces(docs_of, items_of, monkeypatch):
    docs, items = case(2, 150)
    monkeypatch.setattr(search, "BLOCK", 16)
    monkeypatch.setattr(search, "MASKS", 2)
    monkeypatch.setattr(text.pieces, "__defaults__", (40,))
    assert answer(docs_of(docs), items_of(items), item_bytes=600) == brute(docs, items)


def test_empty_tables(docs_of, items_of):
    docs, items = docs_of([(1, "a b")]), items_of([(1, "a")])
    assert answer(docs.filter("false"), items) == answer(docs, items.filter("false")) == []
    assert answer(docs_of([(1, None), (2, "..")]), items) == []


def test_masks_group_documents():
    held = np.array([[1, 0, 1, 0, 1, 0, 0, 0, 1], [1, 0, 0, 0, 1, 0, 0, 1, 0]] + [[0] * 9] * 70, np.uint8)
    docs, group, present = search.masks(np.packbits(held, axis=1), 9)
    assert docs.tolist() == [0, 2, 4, 7, 8]
    assert [tuple(present[g][:2]) for g in group] == [(True, True), (True, False), (True, True), (False, True), (True, False)]
    assert len(present) == 3


def test_masks_that_cannot_enter_are_left_out():
    many = 1000
    docs = np.concatenate([np.arange(many), np.arange(many)[::2], np.arange(20)])
    terms_ = np.concatenate([np.zeros(many, int), np.ones(many // 2, int), np.full(20, 2)])
    gains = np.choose(terms_, [1, 10, 1000])
    block, best = search.Block(docs, terms_, gains, many, 3), search.Best(10)
    masks = search.rank_block(block, np.arange(many), np.zeros(many, bool), np.arange(3), np.ones(3, int), best)
    assert masks == 4 and best.ids.tolist() == list(range(0, 20, 2)) and set(best.scores) == {1011}
    search.MASKS, before = 1, search.MASKS
    try:
        best = search.Best(10)
        assert search.rank_block(block, np.arange(many), np.zeros(many, bool), np.arange(3), np.ones(3, int), best) == 1
    finally:
        search.MASKS = before
    assert best.ids.tolist() == list(range(0, 20, 2))

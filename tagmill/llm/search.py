"""Ranked lexical search by groups of documents that match the same terms of an item.

The documents are read once for each part of the items: every text becomes its length and
the occurrences of the items' terms, kept as a table. Counts over that table give the
weights. A second pass goes through blocks of documents: a bitmap per term says which
documents of the block hold it, the bitmaps of an item's terms give each document its
mask, and the documents of a mask are scored together. Masks come by descending greatest
possible score and end where none can enter the best ``k`` any more.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagmill.llm.common import staged
from tagmill.llm.text import pieces

BEST = 10
# Documents of a block, masks scored at a time, and UTF-8 bytes of items that share one reading of the documents.
BLOCK, MASKS, ITEM_BYTES = 4096, 64, 8 << 20
# Terms are runs of digits, letters and everything beyond ASCII; A-Z are lowered.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

POSTINGS = "doc_id bigint, n bigint, terms array<int>, tfs array<int>"
FOUND = "item int, doc_id bigint, score bigint"


def terms_of(data: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text, a bounded part of the text at a time."""
    for part in pieces((data or b"").translate(TERM_BYTES)):
        yield part.split()


def _occurrences(vocabulary: dict[bytes, int], data: bytes | None) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of terms of a text, and the known ones with their counts."""
    n, counted = 0, []
    for words in terms_of(data):
        n += len(words)
        ids = np.fromiter(map(vocabulary.get, words, repeat(-1)), np.int32, len(words))
        counted.append(np.unique(ids[ids >= 0], return_counts=True))
    ids, counts = (np.concatenate([c[i] for c in counted]) for i in (0, 1))
    if len(counted) > 1:
        ids, where = np.unique(ids, return_inverse=True)
        counts = np.bincount(where, weights=counts, minlength=len(ids))
    return n, ids, counts.astype(np.int32)


def _postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [_occurrences(vocabulary, x.as_py()) for x in batch.column("data")]
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(g[1]) for g in got])]), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, np.int32), *[g[i] for g in got]]), pa.int32()))
                     for i in (1, 2)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([g[0] for g in got], pa.int64()), *lists],
                                             ["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary").alias("data")).mapInArrow(read, POSTINGS)


class Block:
    """Postings of some documents by term, with the bitmaps of the terms."""

    def __init__(self, docs: np.ndarray, terms: np.ndarray, gains: np.ndarray, size: int, vocabulary: int):
        """``docs`` count from 0 to ``size``; ``gains`` are what one occurrence of the term in an item adds to the score."""
        order = np.lexsort((docs, terms))
        self.docs, self.gains, self.size = docs[order], gains[order], size
        self.starts = np.searchsorted(terms[order], np.arange(vocabulary + 1))
        self.most = np.zeros(vocabulary, np.int64)
        np.maximum.at(self.most, terms, gains)

    def bitmap(self, term: int) -> np.ndarray:
        held = np.zeros(self.size, np.uint8)
        held[self.docs[self.starts[term]:self.starts[term + 1]]] = 1
        return np.packbits(held)

    def gain(self, term: int, docs: np.ndarray) -> np.ndarray:
        """What the term adds for documents that all hold it."""
        a, b = self.starts[term], self.starts[term + 1]
        return self.gains[a + np.searchsorted(self.docs[a:b], docs)]


def masks(bitmaps: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents with a term, the group of each, and the terms held by each group, from one bitmap per term."""
    docs = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(bitmaps), count=size))
    held = np.unpackbits(bitmaps, axis=1, count=size)[:, docs].T
    packed = np.packbits(held, axis=1)
    wide = np.zeros((len(docs), -(-packed.shape[1] // 8) * 8), np.uint8)
    wide[:, :packed.shape[1]] = packed
    code, first = np.zeros(len(docs), np.int64), np.zeros(0, np.int64)
    for column in wide.view(np.uint64).T:
        values, inverse = np.unique(column, return_inverse=True)
        _, first, code = np.unique(code * len(values) + inverse, return_index=True, return_inverse=True)
    return docs, code, held[first].astype(bool)


class Best:
    """The best ``k`` documents of an item so far: higher scores first, then smaller ids, unknown ids last."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids, self.unknown = k, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def least(self) -> int:
        """Scores below this one cannot enter."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, unknown: np.ndarray) -> None:
        scores, ids, unknown = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.unknown, unknown)))
        order = np.lexsort((ids, unknown, -scores))[:self.k]
        self.scores, self.ids, self.unknown = scores[order], ids[order], unknown[order]


def rank_block(block: Block, ids: np.ndarray, unknown: np.ndarray, terms: np.ndarray, times: np.ndarray, best: Best) -> int:
    """Bring an item's best documents up to date with a block; the number of masks that were scored."""
    held = block.starts[terms + 1] > block.starts[terms]
    terms, times = terms[held], times[held]
    most = block.most[terms] * times
    if not len(terms) or most.sum() < best.least():
        return 0
    docs, group, present = masks(np.array([block.bitmap(t) for t in terms]), block.size)
    bound = present @ most
    order, done = np.argsort(-bound, kind="stable"), 0
    by_group = np.argsort(group, kind="stable")
    edges = np.searchsorted(group[by_group], np.arange(len(bound) + 1))
    while done < len(order):
        now = order[done:done + MASKS]
        now = now[bound[now] >= best.least()]
        if not len(now):
            break
        at = np.concatenate([by_group[edges[g]:edges[g + 1]] for g in now])
        scores, with_term = np.zeros(len(at), np.int64), present[group[at]]
        for i, term in enumerate(terms):
            mine = with_term[:, i]
            scores[mine] += times[i] * block.gain(term, docs[at[mine]])
        keep = scores >= best.least()
        best.add(scores[keep], ids[docs[at[keep]]], unknown[docs[at[keep]]])
        done += len(now)
    return done


def _ranked(postings: DataFrame, weights: np.ndarray, docs_with_terms: int, all_terms: int,
            items: list[tuple[int, np.ndarray, np.ndarray]], k: int) -> DataFrame:
    """At most ``k`` documents of each task and item."""

    def block_of(batches: list[pa.RecordBatch]) -> tuple[Block, np.ndarray, np.ndarray]:
        table = pa.Table.from_batches(batches).combine_chunks()
        lists = [table.column(c).combine_chunks() for c in ("terms", "tfs")]
        lists = [x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in lists]
        docs = np.repeat(np.arange(len(table)), np.diff(lists[0].offsets.to_numpy()))
        terms, tfs = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in lists)
        m = 25 + 75 * table.column("n").to_numpy().astype(np.int64) * docs_with_terms // max(all_terms, 1)
        gains = weights[terms] * (1_000_000_000 * tfs // (1000 * tfs + 8 * m[docs]))
        ids = table.column("doc_id").combine_chunks()
        return (Block(docs, terms, gains, len(table), len(weights)),
                ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items]

        def take(waiting: list[pa.RecordBatch]) -> None:
            block, ids, unknown = block_of(waiting)
            for (_, terms, times), found in zip(items, best, strict=True):
                rank_block(block, ids, unknown, terms, times, found)

        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            if sum(len(b) for b in waiting) >= BLOCK:
                take(waiting)
                waiting = []
        if sum(len(b) for b in waiting):
            take(waiting)
        for (item, _, _), found in zip(items, best, strict=True):
            if len(found.ids):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found.ids), item), pa.int32()),
                                                  pa.array(found.ids, pa.int64(), mask=found.unknown),
                                                  pa.array(found.scores, pa.int64())], ["item", "doc_id", "score"])

    return postings.filter("size(terms) > 0").mapInArrow(search, FOUND)


def _answer(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """Answers to so few items that their terms and ids fit the driver and every task."""
    vocabulary: dict[bytes, int] = {}
    asked = []
    rows = items.select("item_id", F.col("text").cast("binary").alias("data")).collect()
    for number, row in enumerate(rows):
        ids = [vocabulary.setdefault(w, len(vocabulary)) for words in terms_of(row.data) for w in words]
        asked.append((number, *np.unique(np.array(ids, np.int64), return_counts=True)))
    postings = staged(_postings(docs, vocabulary), "postings")
    total = postings.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(len(vocabulary), np.int64)
    for term, df in postings.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*")).collect():
        weights[term] = floor(1000 * log((2 * total[0] + 2) / (2 * df + 1)))
    found = _ranked(postings, weights, total[0], total[1], asked, k)
    first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)
    names = items.sparkSession.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], "item int, item_id bigint")
    return found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = BEST, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best of ``docs`` (doc_id, text) for each of ``items`` (item_id, text).

    Scores are the integers of the contract, summed over the item's terms with repeats; only scores above 0 count.
    Equal scores go by ascending ``doc_id``, rows without one last. Null and empty texts match nothing but an empty
    text is no document for the averages either. Rows that repeat are rows of their own, documents as well as items;
    an item without terms, or without any matching document, has no row. Empty tables give no rows. Other columns
    are ignored. Texts are whole; long ones are counted in parts. Products are 64-bit: 75 times the terms of the
    longest text times the documents must stay below 2^63.

    Items of more than ``item_bytes`` bytes in all are dealt by hash into parts of about that size, each with a
    reading of its own, so what goes to the driver and to every task is bounded by that parameter (a longer single
    item goes alone). A task keeps ``k`` documents of each item.
    """
    docs, items = docs.select("doc_id", "text"), items.select("item_id", "text")
    size = items.agg(F.coalesce(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16), F.lit(0))).first()[0]
    parts = max(1, -(-size // item_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    answers = [_answer(docs, items if parts == 1 else items.filter(part == p), k) for p in range(parts)]
    out = answers[0]
    for other in answers[1:]:
        out = out.unionByName(other)
    return out


def sql() -> str:
    """The same in DuckDB, every document against every item."""
    terms = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {terms} AS w FROM documents),
    total AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS words FROM d WHERE len(w) > 0),
    q AS (SELECT row_number() OVER () AS i, item_id, unnest({terms}) AS t FROM benchmark),
    qt AS (SELECT i, item_id, t, count(*) AS times FROM q GROUP BY ALL),
    tf AS (SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS t FROM d)
           WHERE t IN (SELECT t FROM qt) GROUP BY ALL),
    df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
    gains AS (SELECT r, doc_id, tf.t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT
                * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words))) AS gain
              FROM tf JOIN df ON tf.t = df.t CROSS JOIN total),
    scored AS (SELECT i, item_id, r, doc_id, sum(times * gain)::BIGINT AS score FROM gains JOIN qt ON gains.t = qt.t GROUP BY ALL)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
    WHERE rank <= {BEST}"""

"""Vocabularies (item to index) and encoding against them."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagmill.operators import ranking
from tagmill.session import BROADCAST_ROWS, is_small


def build(df: DataFrame, start: int = 0) -> DataFrame:
    """Contiguous index of the distinct items, in item order."""
    return ranking.global_index(df.select("item").distinct(), ["item"], start, "idx")


def top(ranked: DataFrame, dim: int) -> DataFrame:
    """``item, idx`` of the items with rank up to ``dim``; the rank is the index."""
    return ranked.filter(F.col("rank") <= dim).select("item", F.col("rank").cast("int").alias("idx"))


def top_by_order(df: DataFrame, dim: int, *order_by: str | Column) -> DataFrame:
    """``item, idx`` (1-based) of the first ``dim`` items in an order; ``dim`` bounds the result."""
    first = df.orderBy(*order_by).limit(dim)
    return first.select("item", F.row_number().over(Window.orderBy(*order_by)).alias("idx"))


def bounded(vocab: DataFrame, rows: int | None) -> DataFrame:
    """Ask for a broadcast when the caller has proved that ``rows`` is an upper bound."""
    return F.broadcast(vocab) if rows is not None and rows <= BROADCAST_ROWS else vocab


def lookup(df: DataFrame, dictionary: DataFrame, key: str, value: str, default, name: str | None = None,
           rows: int | None = None) -> DataFrame:
    """Left lookup of ``df[key]`` in ``dictionary(key, value)`` with a default.

    Catalyst broadcasts the dictionary when its size estimate allows it, and
    splits hot keys of the long side when it does not.
    """
    name = name or value
    slim = dictionary.select(F.col(key).alias("__key"), F.col(value).alias("__value"))
    joined = df.join(bounded(slim, rows), df[key] == F.col("__key"), "left")
    kept = [df[c] for c in df.columns if c != name]
    return joined.select(*kept, F.coalesce("__value", F.lit(default)).alias(name))


def prune(dictionary: DataFrame, used: DataFrame, key: str) -> DataFrame:
    """Dictionary rows whose key occurs in ``used``."""
    return dictionary.join(used.select(key), key, "left_semi")


# Bits of a key filter for each distinct key, bits a key sets, and the most blocks of 4 KB a filter may have (32 MB, broadcast).
FILTER_BITS, FILTER_HASHES, FILTER_BLOCKS = 12, 3, 8192
_BLOCK_BITS = 1 << 15


def _places(key: str, blocks: int) -> tuple[Column, Column]:
    """Block of a key and the positions of its bits there."""
    block = F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")
    return block, F.array(*[F.pmod(F.xxhash64(key, F.lit(i)), F.lit(_BLOCK_BITS)) for i in range(FILTER_HASHES)])


def key_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """A blocked Bloom filter of the values of ``key``: ``block, bits``, one row per block in use.

    Bits are set map-side first, so a task sends at most ``blocks`` rows of 4 KB, however often a key occurs.
    """
    block, places = _places(key, blocks)
    spread = keys.filter(F.col(key).isNotNull()).select(block.alias("block"), F.explode(places).alias("place"))
    return spread.groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits"))


def may_be_in(df: DataFrame, key: str, bits: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``df`` whose key is in the filter: all that are in the keys, and few others. Nothing is exchanged."""
    block, places = _places(key, blocks)
    held = df.join(F.broadcast(bits.select(F.col("block").alias("__block"), F.col("bits").alias("__bits"))), block == F.col("__block"))
    for i in range(FILTER_HASHES):
        place = F.get(places, F.lit(i))
        byte = F.conv(F.hex(F.substring("__bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        held = held.filter(byte.bitwiseAND(F.pow(F.lit(2), place % 8).cast("int")) != 0)
    return held.select(*df.columns)


def prune_large(dictionary: DataFrame, used: DataFrame, key: str) -> DataFrame:
    """``prune`` for a dictionary, and a set of used keys, too large to broadcast.

    A filter of the used keys, broadcast, leaves out most other rows before the
    dictionary is exchanged; the join decides the rest, so the result is exact at
    any size of the filter, which is sized by the number of distinct keys up to
    ``FILTER_BLOCKS``. Null keys match nothing, repeated dictionary rows stay,
    equal used keys meet once. Keys have one type on both sides, which is not a fraction.
    """
    kinds = {dict(df.dtypes)[key] for df in (dictionary, used)}
    if len(kinds) > 1 or kinds & {"float", "double"}:
        raise ValueError(f"types of {key}: {sorted(kinds)}")
    keys = used.select(key).filter(F.col(key).isNotNull()).distinct()
    count = keys.agg(F.approx_count_distinct(key)).first()[0]
    blocks = min(FILTER_BLOCKS, max(1, math.ceil(count * FILTER_BITS / _BLOCK_BITS)))
    likely = may_be_in(dictionary, key, key_filter(keys, key, blocks), blocks)
    return likely.hint("merge").join(keys, key, "left_semi").select(*dictionary.columns)


def expand_tags(bags: DataFrame, tags: DataFrame) -> DataFrame:
    """Replace items by their tag indices: ``bags(entity, item, ...)`` with ``tags(item, tags array<int>)``.

    Gives ``entity, idx, ...``; items without tags disappear.
    """
    joined = bags.join(tags, "item", "inner")
    return joined.select(*[c for c in bags.columns if c != "item"], F.explode("tags").alias("idx"))


def index_tags(tags: DataFrame, start: int = 0) -> tuple[DataFrame, DataFrame]:
    """Give text tags an index: from ``item, tag`` rows to ``(schema(tag, idx), rows(item, idx))``."""
    schema = build(tags.select(F.col("tag").alias("item")), start).withColumnRenamed("item", "tag")
    return schema, tags.join(schema, "tag").select("item", "idx")


def encode_long(bags: DataFrame, vocab: DataFrame, mode: str = "binary", rows: int | None = None) -> DataFrame:
    """``entity, idx, val``: known items only; value 1 (binary) or the number of occurrences (count).

    ``bags`` holds ``entity, item`` and optionally ``cnt``.
    """
    known = bags.join(bounded(vocab.select("item", "idx"), rows), "item", "inner")
    return _collapse(known, mode)


def _collapse(known: DataFrame, mode: str) -> DataFrame:
    if mode == "binary":
        return known.select("entity", "idx").distinct().withColumn("val", F.lit(1.0))
    weight = F.col("cnt") if "cnt" in known.columns else F.lit(1)
    return known.groupBy("entity", "idx").agg(F.sum(weight).cast("double").alias("val"))


def _collapse_adjacent(binary: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``entity, cnt, indices`` to ``entity, idx, val``, where the rows of an entity follow one another.

    Only the sums of the last entity are carried on. Only local values are used inside, so workers need no
    copy of this package.
    """
    def unlike(a: pa.Array, b: pa.Array) -> np.ndarray:
        out = pc.fill_null(pc.not_equal(a, b), False)
        if pa.types.is_floating(a.type):
            out = pc.and_not(out, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
        return pc.or_(out, pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)

    def summed(code: np.ndarray, idx: np.ndarray, cnt: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct pairs of code and index with their sums and how many of the summed were not null."""
        low = idx.min(initial=0)
        span = int(idx.max(initial=0)) - int(low) + 1
        places = None
        if span > 1 << 31:
            places, idx = np.unique(idx, return_inverse=True)
            low, span = 0, len(places)
        key = code * span + (idx - low)
        if len(key) and span * (int(code[-1]) + 1) <= 8 * len(key) + 4096:
            keys = np.flatnonzero(np.bincount(key))
            total, valid = np.bincount(key, cnt)[keys], np.bincount(key, known)[keys]
        else:
            keys, at = np.unique(key, return_inverse=True)
            total, valid = np.bincount(at, cnt, len(keys)), np.bincount(at, known, len(keys))
        code, idx = keys // span, keys % span + low
        return code, idx if places is None else places[idx], total, valid

    def rows(entities: pa.Array, idx: np.ndarray, total: np.ndarray, valid: np.ndarray, kind: pa.DataType) -> pa.RecordBatch:
        val = pa.array(np.ones(len(idx))) if binary else pa.array(total, mask=valid == 0)
        return pa.RecordBatch.from_arrays([entities, pa.array(idx).cast(kind), val], ["entity", "idx", "val"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kind = None, None
        for batch in batches:
            if not len(batch):
                continue
            entity, lists, cnt = (batch.column(c) for c in ("entity", "indices", "cnt"))
            kind = lists.type.value_type
            before = entity.slice(0, 1) if last is None else last[0]
            new = unlike(pa.concat_arrays([before, entity.slice(0, len(entity) - 1)]), entity)
            if last is not None and new[0]:
                yield rows(pa.concat_arrays([last[0]] * len(last[1])) if len(last[1]) else entity.slice(0, 0), *last[1:], kind)
                last = None
            new[0] = False
            owner = np.cumsum(new)
            flat = lists.flatten()
            row = np.repeat(np.arange(len(batch)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            if flat.null_count:
                row, flat = row[flat.is_valid().to_numpy(zero_copy_only=False)], flat.drop_null()
            idx = flat.to_numpy(zero_copy_only=False).astype(np.int64)
            held = pc.is_valid(cnt).to_numpy(zero_copy_only=False).astype(float)
            times = pc.fill_null(cnt, 0).to_numpy(zero_copy_only=False).astype(float)
            parts = [owner[row], idx, times[row], held[row]]
            if last is not None:
                parts = [np.concatenate([a, b]) for a, b in zip([np.zeros(len(last[1]), np.int64), *last[1:]], parts, strict=True)]
            code, idx, total, valid = summed(*parts)
            done = np.searchsorted(code, owner[-1])
            first = np.concatenate([[0], np.flatnonzero(new)])
            if done:
                yield rows(entity.take(pa.array(first[code[:done]])), idx[:done], total[:done], valid[:done], kind)
            last = entity.slice(len(entity) - 1, 1), idx[done:], total[done:], valid[done:]
        if last is not None and len(last[1]):
            yield rows(pa.concat_arrays([last[0]] * len(last[1])), *last[1:], kind)

    return run


def encode_with_tags_long(bags: DataFrame, vocab: DataFrame, tags: DataFrame, dim: int, mode: str = "binary",
                          rows: int | None = None) -> DataFrame:
    """Own index of an item (if known) plus its tag indices shifted by ``dim + 1``.

    Bags collapse to one row per entity and item first, so an entity then has at
    most as many rows as the dictionaries have items. Only those rows are
    exchanged by entity, before small dictionaries are joined; the longer expansion
    is summed entity by entity, as the rows of an entity follow one another.
    """
    weight = F.col("cnt") if "cnt" in bags.columns else F.lit(1)
    counted = bags.groupBy("entity", "item").agg(F.sum(weight).cast("bigint").alias("cnt"))
    own, more = vocab.select("item", F.array("idx").alias("own")), tags.select("item", "tags")
    small = (rows <= BROADCAST_ROWS if rows is not None else is_small(own)) and is_small(more)
    if small:
        # Lists instead of a sort, which Catalyst would leave out below a join.
        listed = counted.repartition("entity").groupBy("entity").agg(F.collect_list(F.struct("item", "cnt")).alias("rows"))
        counted = listed.select("entity", F.inline("rows"))
        own, more = F.broadcast(own), F.broadcast(more)
    known = counted.join(bounded(own, rows), "item", "left").join(more, "item", "left")
    shifted = F.transform("tags", lambda t: t + F.lit(dim + 1))
    none = F.array().cast("array<int>")
    indices = F.concat(F.coalesce("own", none), F.coalesce(shifted, none))
    together = known.filter(F.col("own").isNotNull() | F.col("tags").isNotNull()).select("entity", "cnt", indices.alias("indices"))
    if not small:
        together = together.repartition("entity").sortWithinPartitions("entity")
    kinds = {f.name: f.dataType for f in together.schema}
    schema = T.StructType([T.StructField("entity", kinds["entity"]), T.StructField("idx", kinds["indices"].elementType),
                           T.StructField("val", T.DoubleType())])
    return together.mapInArrow(_collapse_adjacent(mode == "binary"), schema)


def to_vectors(encoded: DataFrame) -> DataFrame:
    """``entity, idxs, vals`` with ascending indices: one row holds at most the vocabulary."""
    pairs = F.sort_array(F.collect_list(F.struct("idx", "val")))
    return (encoded.groupBy("entity").agg(pairs.alias("pairs"))
            .select("entity", F.col("pairs.idx").alias("idxs"), F.col("pairs.val").alias("vals")))


def encode(bags: DataFrame, vocab: DataFrame, mode: str = "binary", rows: int | None = None) -> DataFrame:
    """Sparse vectors ``entity, idxs, vals`` against a vocabulary."""
    return to_vectors(encode_long(bags, vocab, mode, rows))


def encode_with_tags(bags: DataFrame, vocab: DataFrame, tags: DataFrame, dim: int, mode: str = "binary",
                     rows: int | None = None) -> DataFrame:
    """Sparse vectors of own and tag indices."""
    return to_vectors(encode_with_tags_long(bags, vocab, tags, dim, mode, rows))


def write(vocab: DataFrame, path: str) -> None:
    """Write ``item<TAB>index`` lines under ``path/schema``."""
    (vocab.select(F.concat_ws("\t", vocab.columns[0], "idx").alias("value"))
     .write.mode("overwrite").text(path.rstrip("/") + "/schema"))

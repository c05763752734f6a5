"""Weighted similarity fingerprints."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagmill.functions.hashing import folder, width_or_default
from tagmill.operators import sessions, vocab

# Weights are counted in steps of the entity's greatest weight rounded up to a power of two, divided by 2 to this.
STEPS = 40
# Sums travel as two whole numbers, multiples of 2 to this and the rest.
HALF = 20
# Bits summed by one row of aggregates; wider fingerprints use several rows.
CHUNK = 64
# Hashes that a task remembers.
REMEMBERED = 1 << 17
# Cells per row of a batch up to which its entities and tokens are counted in a table, and the most that a table may count.
TABLE, COUNTED = 32, 1 << 32


def _partial_sums(bits: int, variant: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Per batch, the signed weight sums of each entity in whole steps: ``entity, chunk, terms, high, low``.

    Only local values are used inside, so workers need no copy of this package.
    """
    fold, size = folder(bits, variant), width_or_default(bits) // 8
    used, chunk_bits, steps, half, most = min(bits, size * 8), CHUNK, STEPS, HALF, REMEMBERED
    table, counted = TABLE, COUNTED

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, bytes] = {}
        for batch in batches:
            if batch.empty:
                continue
            owner, entities = pd.factorize(batch["entity"])
            token, tokens = pd.factorize(batch["token"])
            new = [t for t in tokens if t not in known]
            if len(known) + len(new) > most:
                known.clear()
                new = list(tokens)
            known.update(zip(new, (row.tobytes() for row in fold(new)), strict=True))
            # One row of +1/-1 per token, bit 0 first, and a zero row for NULL tokens (code -1).
            signs = np.full((len(tokens) + 1, bits), -1, np.int64)
            if len(tokens):
                raw = np.frombuffer(b"".join(known[t] for t in tokens), np.uint8).reshape(len(tokens), size)
                signs[:-1, :used] += 2 * np.unpackbits(raw, axis=1, bitorder="little")[:, :used].astype(np.int64)
            signs[-1] = 0
            order = np.argsort(owner, kind="stable")
            starts = np.searchsorted(owner[order], np.arange(len(entities)))
            times = batch["n"].to_numpy(np.int64)[order]
            power = np.frexp(batch["most"].to_numpy(np.float64)[order])[1]
            whole = np.rint(np.ldexp(batch["weight"].to_numpy(np.float64)[order], steps - power)).astype(np.int64)
            token = token[order]
            terms = np.add.reduceat(np.where(token < 0, 0, times), starts)
            high, low = (whole >> half) * times, (whole & ((1 << half) - 1)) * times
            cells, places = len(entities) * len(signs), None
            if cells <= table * len(batch) and np.abs(times).sum(dtype=float) < counted:
                # Whole numbers below 2^53, so sums of doubles are exact: entities by tokens, times the signs of the tokens.
                places = owner[order] * len(signs) + token % len(signs)
                tables = [np.bincount(places, part, cells).reshape(-1, len(signs)) for part in (high, low)]
            for chunk, first in enumerate(range(0, bits, chunk_bits)):
                if places is not None:
                    two = [(t @ signs[:, first:first + chunk_bits].astype(float)).astype(np.int64) for t in tables]
                    yield pd.DataFrame({"entity": entities, "chunk": np.int32(chunk), "terms": terms, "high": list(two[0]), "low": list(two[1])})
                    continue
                sign = signs[token, first:first + chunk_bits]
                yield pd.DataFrame({"entity": entities, "chunk": np.int32(chunk), "terms": terms,
                                    "high": list(np.add.reduceat(sign * high[:, None], starts, axis=0)),
                                    "low": list(np.add.reduceat(sign * low[:, None], starts, axis=0))})

    return sums


def simhash(tokens: DataFrame, bits: int = 64, variant: str = "1a", colocate: bool = False, uniform: float | None = None) -> DataFrame:
    """Fingerprint text of 0/1, bit 0 first, from ``entity, token, weight`` rows.

    A bit is 1 if its signed weight sum is not negative, so an entity whose
    tokens are all NULL (or weigh 0) gets only ones. Equal tokens of an entity
    are counted first. Weights become whole steps of the entity's own scale and
    sums are sums of whole numbers, so neither the order of rows nor a factor
    common to all weights decides a bit; a sum within half a step per term of
    zero is zero. Missing and NaN weights count 0, infinite ones as the greatest number.

    Each Arrow batch is reduced to one row of bit sums per entity before the
    shuffle, and those rows are summed map-side again, so a heavy entity never
    meets in one task. ``colocate`` brings rows of an entity together before; the
    exchange is a rebalance, whose oversized partitions are split again at run time.

    ``uniform`` is the weight of every row, where the caller gives ``entity, token`` alone: with the
    scale known and sums indifferent to the order of rows, no token is exchanged at all, only the sums.
    """
    if uniform is not None:
        known = F.lit(float(uniform))
        plain = tokens.filter(F.col("entity").isNotNull()).select(
            "entity", "token", known.alias("weight"), F.lit(1).cast("bigint").alias("n"), F.abs(known).alias("most"))
        return _summed(plain.hint("rebalance", "entity").sortWithinPartitions("entity") if colocate else plain, bits, variant)
    limit = F.lit(1.7976931348623157e308)
    weight = F.least(F.greatest(F.nanvl(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0)), -limit), limit)
    rows = tokens.filter(F.col("entity").isNotNull()).select("entity", "token", weight.alias("weight"))
    counted = rows.groupBy("entity", "token", "weight").agg(F.count("*").alias("n"))
    scale = counted.groupBy(F.col("entity").alias("owner")).agg(F.max(F.abs("weight")).alias("most"))
    scaled = counted.join(scale, F.col("entity") == F.col("owner")).select("entity", "token", "weight", "n", "most")
    if colocate:
        scaled = scaled.hint("rebalance", "entity").sortWithinPartitions("entity")
    return _summed(scaled, bits, variant)


def _summed(scaled: DataFrame, bits: int, variant: str) -> DataFrame:
    """Fingerprints of ``entity, token, weight, n, most``: batches are reduced before the only exchange."""
    schema = T.StructType([scaled.schema["entity"], T.StructField("chunk", T.IntegerType()), T.StructField("terms", T.LongType()),
                           *[T.StructField(name, T.ArrayType(T.LongType())) for name in ("high", "low")]])
    partial = scaled.mapInPandas(_partial_sums(bits, variant), schema)
    width = min(bits, CHUNK)
    total = partial.groupBy("entity", "chunk").agg(
        F.sum("terms").alias("terms"), *[F.sum(F.get(name, F.lit(i))).alias(f"{name}{i}") for i in range(width) for name in ("high", "low")])
    rest = F.lit((1 << HALF) - 1).cast("bigint")
    # A sum counts as negative if it is below the rounding of its terms; a position past the last bit has no sum and adds no digit.
    least = -F.col("terms")
    least_high, least_low = F.shiftright(least, HALF), least.bitwiseAND(rest)

    def digit(i: int) -> Column:
        high, low = F.col(f"high{i}") + F.shiftright(F.col(f"low{i}"), HALF), F.col(f"low{i}").bitwiseAND(rest)
        reached = (high > least_high) | ((high == least_high) & (low >= least_low))
        return F.when(reached, F.lit("1")).when(F.col(f"high{i}").isNotNull(), F.lit("0"))

    digits = F.concat_ws("", *[digit(i) for i in range(width)])
    pieces = total.select("entity", "chunk", digits.alias("bits"))
    if bits <= CHUNK:
        return pieces.select("entity", "bits")
    ordered = F.sort_array(F.collect_list(F.struct("chunk", "bits")))
    return pieces.groupBy("entity").agg(F.array_join(ordered.getField("bits"), "").alias("bits"))


def to_indices(df: DataFrame, start: int = 0) -> DataFrame:
    """Positions of the set bits, shifted by ``start``."""
    digits = F.split("bits", "")
    marked = F.transform(digits, lambda d, i: F.when(d == "1", i + F.lit(start)))
    return df.select("entity", F.array_compact(marked).alias("idxs"))


def activity_tokens(records: DataFrame, weights: DataFrame, order_by: list[str] | None = None,
                    limit: int | None = None) -> DataFrame:
    """``entity, token, weight``: distinct names and referrers of each record, weighted by its app.

    ``records`` holds ``entity, app, activities``; ``weights`` holds ``app, weight``; an app without
    weight counts 0. With ``limit`` only that many records per entity are used.
    """
    if limit is not None:
        records = sessions.cap_records(records, order_by or ["time"], limit)
    weighted = vocab.lookup(records, weights, "app", "weight", 0.0)
    texts = F.array_compact(F.array_distinct(F.concat("activities.name", "activities.refer")))
    return weighted.select("entity", F.explode_outer(texts).alias("token"), "weight")


def activity(records: DataFrame, weights: DataFrame, bits: int = 128, start: int = 0,
             order_by: list[str] | None = None, limit: int = sessions.RECORDS_PER_ENTITY) -> DataFrame:
    """Set-bit positions of each entity's activity fingerprint."""
    tokens = activity_tokens(records, weights, order_by, limit)
    return to_indices(simhash(tokens, bits, "1a"), start)

"""Global positions, ranks and running sums without moving all rows to one task.

The rows are range-sorted once and written to the checkpoint folder, which fixes
which row sits in which partition. A row's position is then its place in its own
partition plus the number of rows in the partitions before it; only one number
per partition is ever summed centrally.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagmill.session import broadcast_if_small, checkpoint

_PARTITION, _POSITION, _BASE, _TIE, _CHANGES = "__partition", "__position", "__base", "__tie", "__changes"
_POSITION_BITS = 33


def _place(df: DataFrame, order_by: Sequence[Column | str]) -> DataFrame:
    """Sort, fix the partitioning, and add partition number and place in it."""
    fixed = checkpoint(df.orderBy(*order_by))
    marker = F.monotonically_increasing_id()
    return (fixed.withColumn(_BASE, marker)
            .withColumn(_PARTITION, F.shiftright(_BASE, _POSITION_BITS))
            .withColumn(_POSITION, F.col(_BASE).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
            .drop(_BASE))


def _before(totals: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn per-partition totals into sums over earlier partitions (one row per partition)."""
    earlier = Window.orderBy(_PARTITION).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(_PARTITION, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in columns])


def global_index(df: DataFrame, order_by: Sequence[Column | str], start: int = 0, name: str = "idx") -> DataFrame:
    """Add the contiguous position of each row in the given order, from ``start``.

    ``order_by`` must identify a row, else ties get an arbitrary order.
    """
    placed = _place(df, order_by)
    base = _before(placed.groupBy(_PARTITION).agg(F.count("*").alias(_BASE)), [_BASE])
    # One row per partition of the sort: bounded by spark.sql.shuffle.partitions.
    joined = placed.join(F.broadcast(base), _PARTITION)
    return joined.select(*df.columns, (F.col(_BASE) + F.col(_POSITION) + F.lit(start)).alias(name))


def group_index(df: DataFrame, groups: Sequence[str], order_by: Sequence[Column | str], start: int = 1,
                name: str = "rank") -> DataFrame:
    """Row number inside each group; a group may hold most of the rows."""
    if not groups:
        return global_index(df, order_by, start, name)
    placed = global_index(df, [*groups, *order_by], 0, _POSITION)
    first = placed.groupBy(*groups).agg(F.min(_POSITION).alias(_BASE))
    # With few groups a join by shuffle would gather each group in one place.
    joined = placed.join(broadcast_if_small(first), list(groups))
    return joined.select(*df.columns, (F.col(_POSITION) - F.col(_BASE) + F.lit(start)).alias(name))


def _changes(keys: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds, to the sorted rows of a partition, how often the keys changed since its first row."""
    def differs(a: pa.Array, b: pa.Array) -> np.ndarray:
        unlike = pc.fill_null(pc.not_equal(a, b), False)
        if pa.types.is_floating(a.type):
            unlike = pc.and_not(unlike, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
        return pc.or_(unlike, pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count = None, 0
        for batch in batches:
            if not len(batch):
                continue
            new = np.zeros(len(batch), bool)
            for i, key in enumerate(keys):
                column = batch.column(key)
                before = column.slice(0, 1) if last is None else last[i]
                new |= differs(pa.concat_arrays([before, column.slice(0, len(column) - 1)]), column)
            total = count + np.cumsum(new)
            last, count = [batch.column(key).slice(len(batch) - 1, 1) for key in keys], int(total[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(total, pa.int64())], [*batch.schema.names, _CHANGES])

    return run


def dense_index(df: DataFrame, groups: Sequence[str], value: str, start: int = 1, name: str = "rank") -> DataFrame:
    """Dense rank of ``value`` inside each group, nulls last; null groups are a group.

    The range sort may cut between equal values, so a value that most rows have is spread over
    many tasks. Each partition counts the changes of (groups, value) among its rows; of a partition
    only its first and last key and that number are needed to carry on in the next.
    """
    keys = [*groups, value]
    placed = _place(df.withColumn(_TIE, F.monotonically_increasing_id()), [*groups, F.col(value).asc_nulls_last(), _TIE])
    scanned = placed.mapInArrow(_changes(keys), T.StructType([*placed.schema, T.StructField(_CHANGES, T.LongType())]))
    key = F.struct(*keys)
    ends = scanned.groupBy(_PARTITION).agg(F.min_by(key, _POSITION).alias("first"), F.max_by(key, _POSITION).alias("last"),
                                           F.max(_CHANGES).alias("inside"))
    # One row per partition of the sort: bounded by spark.sql.shuffle.partitions.
    order = Window.orderBy(_PARTITION)
    before = F.lag("last").over(order)
    step = F.when(before.isNull() | before.eqNullSafe(F.col("first")), 0).otherwise(1)
    ends = ends.select(_PARTITION, (step + F.coalesce(F.lag("inside").over(order), F.lit(0))).alias("step"))
    base = ends.select(_PARTITION, F.sum("step").over(order).alias(_BASE))
    ranked = scanned.join(F.broadcast(base), _PARTITION).withColumn(_CHANGES, F.col(_CHANGES) + F.col(_BASE))
    if not groups:
        return ranked.select(*df.columns, (F.col(_CHANGES) + F.lit(start)).alias(name))
    first = ranked.groupBy(*[F.col(g).alias(f"__{g}") for g in groups]).agg(F.min(_CHANGES).alias("__first"))
    same = [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in groups]
    return ranked.join(broadcast_if_small(first), same).select(
        *df.columns, (F.col(_CHANGES) - F.col("__first") + F.lit(start)).alias(name))


def running_sums(df: DataFrame, order_by: Sequence[Column | str], sums: Mapping[str, str]) -> DataFrame:
    """Add, for each ``{name: column}``, the sum of ``column`` over all earlier rows."""
    placed = _place(df, order_by)
    totals = placed.groupBy(_PARTITION).agg(*[F.sum(c).alias(f"__{n}") for n, c in sums.items()])
    base = _before(totals, [f"__{n}" for n in sums])
    earlier = (Window.partitionBy(_PARTITION).orderBy(_POSITION)
               .rowsBetween(Window.unboundedPreceding, -1))
    local = placed.select("*", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(n) for n, c in sums.items()])
    joined = local.join(F.broadcast(base), _PARTITION)
    return joined.select(*df.columns, *[(F.col(n) + F.col(f"__{n}")).alias(n) for n in sums])


def smallest_by_hash(df: DataFrame, groups: Sequence[str], hash_column: str, ties: Sequence[str], quota: str,
                     prefix: int = 4) -> DataFrame:
    """Keep, per group, the ``quota`` rows with the smallest hexadecimal hash (then ``ties``).

    Rows are counted per group and hash prefix (``16 ** prefix`` small counts per
    group). Whole prefixes below the quota are kept by a map-side test; only the
    prefix the quota falls into has to be ranked. ``quota`` is a column of ``df``
    that is constant inside a group.
    """
    keyed = df.withColumn("__prefix", F.substring(hash_column, 1, prefix))
    counts = keyed.groupBy(*groups, "__prefix").agg(F.count("*").alias("__n"))
    earlier = (Window.partitionBy(*groups).orderBy("__prefix")
               .rowsBetween(Window.unboundedPreceding, -1))
    start = counts.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    marked = keyed.join(start, [*groups, "__prefix"]).filter(F.col("__before") < F.col(quota))
    whole = F.col("__before") + F.col("__n") <= F.col(quota)
    inside = Window.partitionBy(*groups, "__prefix").orderBy(hash_column, *ties)
    edge = (marked.filter(~whole).withColumn("__rank", F.row_number().over(inside))
            .filter(F.col("__before") + F.col("__rank") <= F.col(quota)))
    return marked.filter(whole).select(*df.columns).unionByName(edge.select(*df.columns))

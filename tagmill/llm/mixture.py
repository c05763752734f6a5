"""Mixing sources to target weights by thresholds on a hash, found from histograms. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmill.llm.common import staged

WEIGHTS, SHARE_PERCENT, MOST_COPIES = (5, 2, 1), 150, 2
# The hash has 60 bits; the histogram has 2^12 cells per source, the refined one 2^12 cells per boundary cell.
HASH_DIGITS, CELL_BITS = 15, 12
_BITS = 4 * HASH_DIGITS
WORD = r"[^\x20\x09-\x0D]+"


def hash_of(column: str = "doc_id") -> Column:
    """First 60 bits of the MD5 of an id's text; null ids count as the empty text."""
    digits = F.substring(F.md5(F.coalesce(F.col(column).cast("string"), F.lit(""))), 1, HASH_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint")


def sized(docs: DataFrame) -> DataFrame:
    """The rows with ``size`` (words of the text, null counts 0) and ``h``."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
                       hash_of().alias("h"))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = SHARE_PERCENT,
            most: int = MOST_COPIES) -> DataFrame:
    """``source, source_size, target``: weights by order of sources share ``percent`` of all sizes.

    A target stops at ``most`` times its source; what is above goes to the others
    by weight. All targets are ``least(cap, level * weight)`` for one level, so
    the capped sources are the first ones by cap per weight. One row per source
    meets in a window; documents never do.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1))
    rows = total.select("source", "source_size", weight.cast("bigint").alias("weight"), (most * F.col("source_size")).alias("cap"))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "weight", F.col("source").asc_nulls_last())
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    # Numerators are kept in hundredths of words, so they stay whole.
    left = F.sum("source_size").over(everything) * percent - 100 * F.coalesce(F.sum("cap").over(earlier), F.lit(0))
    left_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))
    staged_rows = rows.select("*", left.alias("left"), left_weight.alias("left_weight"), F.row_number().over(by_ratio).alias("k"))
    fits = F.col("left") * F.col("weight") <= 100 * F.col("cap") * F.col("left_weight")
    # The first source that stays below its cap fixes the level for itself and all later ones.
    level = F.min(F.when(fits, F.struct("k", "left", "left_weight"))).over(everything)
    open_ = F.col("k") >= F.col("level.k")
    shared = (F.col("level.left") * F.col("weight")).cast("double") / (100 * F.col("level.left_weight")).cast("double")
    return (staged_rows.withColumn("level", level)
            .select("source", "source_size", F.when(open_, shared).otherwise(F.col("cap").cast("double")).alias("target")))


def _boundary(cells: DataFrame, keys: list[str], start: Column) -> DataFrame:
    """Per key the cell in which the running sum passes the budget, with the sum before it.

    Windows hold the cells of one source (at most ``2^CELL_BITS``).
    """
    order = Window.partitionBy(*keys).orderBy("cell")
    upto = start + F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = cells.withColumn("upto", upto)
    return placed.filter((F.col("upto") - F.col("n") <= F.col("budget")) & (F.col("budget") < F.col("upto")))


def plan(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """``source, source_size, target, whole, below``: every document is taken ``whole`` times, and once more
    if its hash is smaller than ``below``.

    Budgets are nested: a smaller one always takes a subset. Only documents of the boundary cell are looked at
    again, on finer cells, and only hashes of one fine cell are put in order. The document at the edge is taken
    if that brings the sum nearer to the target. Rows that repeat an id share its hash and go together.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goals = goals.withColumn("whole", whole).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    goals = staged(goals.withColumn("part", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))), "goals")
    shift = _BITS - CELL_BITS
    counts = (rows.withColumn("cell", F.shiftright("h", shift)).groupBy("source", "cell").agg(F.sum("size").alias("n")))
    coarse = _boundary(counts.join(goals, counts["source"].eqNullSafe(goals["source"])).select("part", "budget", "cell", "n"),
                       ["part"], F.lit(0))
    edge = goals.join(coarse.select("part", F.col("cell").alias("edge"), (F.col("upto") - F.col("n")).alias("before")), "part")
    near = rows.join(edge.withColumnRenamed("source", "s"),
                     F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("h", shift) == F.col("edge")))
    near = near.groupBy("part", "budget", "before", "h").agg(F.sum("size").alias("n"))
    fine_shift = shift - CELL_BITS
    near = staged(near.withColumn("cell", F.shiftright("h", fine_shift)), "edge")
    fine = _boundary(near.groupBy("part", "budget", "before", "cell").agg(F.sum("n").alias("n")), ["part"], F.col("before"))
    fine = fine.select("part", "cell", (F.col("upto") - F.col("n")).alias("start"))
    order = Window.partitionBy("part").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    last = near.join(fine, ["part", "cell"]).withColumn("upto", F.col("start") + F.sum("n").over(order))
    # A hash stays out once the sums before and after it are, together, more than twice the budget.
    over = F.col("upto") * 2 - F.col("n") > 2 * F.col("budget")
    end = F.shiftleft(F.max("cell") + 1, fine_shift)
    cut = last.groupBy("part").agg(F.coalesce(F.min(F.when(over, F.col("h"))), end).alias("below"))
    return (goals.join(cut, "part", "left")
            .select("source", "source_size", "target", "whole", F.coalesce("below", F.lit(0)).alias("below")))


def _copies() -> Column:
    return (F.col("whole") + F.when(F.col("h") < F.col("below"), 1).otherwise(0)).cast("bigint")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = SHARE_PERCENT, most: int = MOST_COPIES) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``.

    Null sources are one source, null texts have size 0. The choice depends on
    ids only, so reruns and other partitionings agree.
    """
    rows = staged(sized(docs), "sizes")
    chosen = plan(rows, targets(rows, weights, percent, most)).withColumnRenamed("source", "s")
    joined = rows.join(chosen, F.col("source").eqNullSafe(F.col("s")), "left")
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * _copies()).alias("taken"))


def apply(docs: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = SHARE_PERCENT, most: int = MOST_COPIES) -> DataFrame:
    """The mixed documents themselves: rows are left out, kept or repeated."""
    rows = staged(sized(docs), "sizes")
    chosen = plan(rows, targets(rows, weights, percent, most)).select(F.col("source").alias("__s"), "whole", "below")
    joined = docs.join(chosen, F.col("source").eqNullSafe(F.col("__s")), "left").withColumn("h", hash_of())
    copies = joined.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), _copies().cast("int"))))
    return copies.select(*docs.columns)


def sql(weights: Sequence[int] = WEIGHTS, percent: int = SHARE_PERCENT, most: int = MOST_COPIES) -> str:
    """The same by full sorting, for DuckDB."""
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, {HASH_DIGITS}))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY source),
w AS (SELECT *, {most} * source_size AS cap, list_element({list(weights)}, (i % {len(weights)} + 1)::INT)::BIGINT AS weight FROM s),
fill AS (
  SELECT 0 AS step, source, cap, weight, false AS full_,
    (SELECT sum(source_size)::BIGINT * {percent} FROM w) AS rest, (SELECT sum(weight)::BIGINT FROM w) AS rest_weight FROM w
  UNION ALL
  SELECT step + 1, source, cap, weight, full_, rest, rest_weight FROM (
    SELECT step, source, cap, weight, now AS full_, bool_or(now <> full_) OVER () AS changed,
      (SELECT sum(source_size)::BIGINT * {percent} FROM w) - 100 * coalesce(sum(cap) FILTER (now) OVER (), 0)::BIGINT AS rest,
      coalesce(sum(weight) FILTER (NOT now) OVER (), 0)::BIGINT AS rest_weight
    FROM (SELECT *, full_ OR rest * weight > 100 * cap * rest_weight AS now FROM fill)) WHERE changed),
t AS (SELECT w.source, source_size, CASE WHEN full_ THEN w.cap::DOUBLE
    ELSE (rest * w.weight)::DOUBLE / (100 * rest_weight)::DOUBLE END AS target
  FROM w JOIN fill ON w.source IS NOT DISTINCT FROM fill.source AND step = (SELECT max(step) FROM fill)),
b AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
k AS (SELECT source, h, sum(size) AS n, sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS upto FROM d GROUP BY source, h)
SELECT d.doc_id, d.size, b.source_size, b.target,
  d.size * (b.whole + CASE WHEN 2 * k.upto - k.n <= 2 * (b.target - b.whole * b.source_size) THEN 1 ELSE 0 END)::BIGINT AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source JOIN k ON d.source IS NOT DISTINCT FROM k.source AND d.h = k.h"""

"""Quality rules whose thresholds come from mergeable quantile sketches per language and source."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagmill.llm.common import staged
from tagmill.llm.text import SPACE, pieces

SYMBOLS = b"#*$%&|<>"
GROUP = ("lang", "source")
# Relative width of a sketch cell, rows a group needs for thresholds of its own, and widths of the fence.
CELL, LEAST_ROWS, REACH = 1.05, 100, 3.0
# Quantiles of a sketch: lower tail, middle, upper tail.
QUANTILES = {"low": 0.1, "mid": 0.5, "high": 0.9}
# Measures and the smallest distance of their fence from the tail quantile, about what a sketch resolves.
UPPER = {"symbol_share": 0.02, "dup_line_share": 0.05, "repeat_share": 0.05, "mean_chars": 0.5, "log_words": 0.5}
LOWER = {"mean_chars": 0.5, "log_words": 0.5}
# Counts that are no evidence whatever their share: a few symbols or lines, two windows.
FEW = {"symbol_share": ("n_symbols", 3), "dup_line_share": ("n_dup_lines", 3), "repeat_share": ("n_repeat_words", 6)}
# A fence lies at most so many times as far from the middle as the usual one of its language; groups that make a usual one.
WIDEST, LEAST_GROUPS = 2.0, 3
MIN_WORDS = 50


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """Words inside 3-word windows that occur at least twice."""
    if len(ids) < 4:
        return 0
    first, second, third = ids[:-2], ids[1:-1], ids[2:]
    if distinct < 1 << 20:
        windows = (first * distinct + second) * distinct + third
    else:
        windows = np.unique(first * distinct + second, return_inverse=True)[1] * distinct + third
    _, place, times = np.unique(windows, return_inverse=True, return_counts=True)
    again = times[place] > 1
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift:shift + len(again)] |= again
    return int(covered.sum())


def measures(text: bytes) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the lines that have a word."""
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    parts = []
    for part in pieces(text):
        words = part.split()
        parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
    ids = np.concatenate(parts)
    blanks = sum(text.count(c) for c in SPACE)
    continued = len(text.translate(None, bytes(b for b in range(256) if not 0x80 <= b < 0xC0)))
    lines = [line for line in text.split(b"\n") if line.strip(SPACE)]
    return (len(ids), len(text) - continued - blanks, sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)),
            repeated_words(ids, len(numbers)), len(lines))


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [measures(text or b"") for text in batch.column("text").to_pylist()]
        table = np.array(rows, np.int64).reshape(len(rows), len(NAMES))
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", *GROUP)],
                                          *[pa.array(table[:, i]) for i in range(len(NAMES))]], names=["doc_id", *GROUP, *NAMES])


def measure(docs: DataFrame) -> DataFrame:
    """The measures of every whole text with its id, language and source; null texts count as empty."""
    kinds = dict(docs.dtypes)
    schema = ", ".join([*[f"{c} {kinds[c]}" for c in ("doc_id", *GROUP)], *[f"{n} bigint" for n in NAMES]])
    return docs.select("doc_id", *GROUP, F.col("text").cast("binary").alias("text")).mapInArrow(_measured, schema)


def _shares() -> dict:
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return {"symbol_share": F.col("n_symbols") / words, "dup_line_share": F.col("n_dup_lines") / lines,
            "repeat_share": F.col("n_repeat_words") / words, "mean_chars": F.col("word_chars") / words,
            "log_words": F.log1p(F.col("n_words"))}


def sketch(measured: DataFrame) -> DataFrame:
    """``lang, source, measure, cell, n``: counts in cells whose bounds grow by the factor ``CELL``.

    Sketches of two sets of rows merge by adding the counts of equal cells, which
    is what Spark's partial sums do, and quantiles are right to one cell. The cell
    of zero is null. A group has a few hundred cells whatever its size.
    """
    cells = F.array(*[F.struct(F.lit(name).alias("measure"), F.ceil(F.log(value) / F.log(F.lit(CELL))).alias("cell"))
                      for name, value in _shares().items()])
    return (measured.select(*GROUP, F.explode(cells).alias("c")).groupBy(*GROUP, "c.measure", "c.cell")
            .agg(F.count("*").alias("n")))


def _quantiles(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Lower tail, middle and upper tail per key and measure; windows hold the cells of one sketch only."""
    per_sketch = Window.partitionBy(*keys, "measure")
    running = per_sketch.orderBy(F.col("cell").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    value = F.coalesce(F.pow(F.lit(CELL), F.col("cell") - 0.5), F.lit(0.0))
    placed = cells.select(*keys, "measure", value.alias("value"), F.sum("n").over(running).alias("upto"),
                          F.sum("n").over(per_sketch).alias("rows"))
    return placed.groupBy(*keys, "measure").agg(F.first("rows").alias("rows"), F.struct(*[
        F.min(F.when(F.col("upto") >= share * F.col("rows"), F.col("value"))).alias(name)
        for name, share in QUANTILES.items()]).alias("q"))


def _usual(own: DataFrame, keys: list[str], least_rows: int) -> DataFrame:
    """``groups, usual``: the (lower) median of the groups' quantiles, each group with one vote whatever its rows."""
    return own.filter(F.col("rows") >= least_rows).groupBy(*keys, "measure").agg(F.count("*").alias("groups"), F.struct(*[
        F.percentile_approx(f"q.{name}", 0.5, 10000).alias(name) for name in QUANTILES]).alias("usual"))


def thresholds(cells: DataFrame, least_rows: int = LEAST_ROWS, reach: float = REACH) -> DataFrame:
    """``lang, source`` and one upper (lower) bound per measure.

    A bound is the upper tail quantile plus ``reach`` times its distance from the
    middle, likewise below. A group of fewer than ``least_rows`` rows takes the
    sketch merged over its language, a language that small the one merged over
    everything. A group whose tail is junk would pass its own junk, so its bounds
    are held to ``WIDEST`` times those of the usual group of its language, or of
    all groups if the language has fewer than ``LEAST_GROUPS`` of that size.
    """
    cells = staged(cells, "sketch")
    own = staged(_quantiles(cells, list(GROUP)), "quantiles")
    by_lang = _quantiles(cells.groupBy("lang", "measure", "cell").agg(F.sum("n").alias("n")), ["lang"])
    overall = _quantiles(cells.groupBy("measure", "cell").agg(F.sum("n").alias("n")), [])

    def same_lang(name: str):
        return F.col("o.lang").eqNullSafe(F.col(f"{name}.lang")) & (F.col("o.measure") == F.col(f"{name}.measure"))

    # One row per measure in the broadcast tables.
    joined = (own.alias("o").join(by_lang.alias("l"), same_lang("l"))
              .join(F.broadcast(overall).alias("a"), F.col("o.measure") == F.col("a.measure"))
              .join(_usual(own, ["lang"], least_rows).alias("ul"), same_lang("ul"), "left")
              .join(F.broadcast(_usual(own, [], least_rows)).alias("ua"), F.col("o.measure") == F.col("ua.measure"), "left"))
    level = (F.when(F.col("o.rows") >= least_rows, F.col("o.q")).when(F.col("l.rows") >= least_rows, F.col("l.q")).otherwise(F.col("a.q")))
    usual = F.when(F.col("ul.groups") >= LEAST_GROUPS, F.col("ul.usual")).when(F.col("ua.groups") >= LEAST_GROUPS, F.col("ua.usual"))
    spread = joined.select("o.lang", "o.source", "o.measure", level.alias("q"), usual.alias("u"))

    def fence(column: str, tail: str, least: float, sign: int):
        out = sign * (F.col(f"{column}.{tail}") - F.col(f"{column}.mid"))
        return F.col(f"{column}.{tail}") + sign * F.greatest(F.lit(least), reach * out)

    bounds = []
    for name, least in UPPER.items():
        widest = F.col("u.mid") + WIDEST * (fence("u", "high", least, 1) - F.col("u.mid"))
        bounds.append(F.max(F.when(F.col("measure") == name, F.least(fence("q", "high", least, 1), widest))).alias(f"max_{name}"))
    for name, least in LOWER.items():
        widest = F.col("u.mid") + WIDEST * (fence("u", "low", least, -1) - F.col("u.mid"))
        bounds.append(F.max(F.when(F.col("measure") == name, F.greatest(fence("q", "low", least, -1), widest))).alias(f"min_{name}"))
    return spread.groupBy(*GROUP).agg(*bounds)


def judge(docs: DataFrame, least_rows: int = LEAST_ROWS, reach: float = REACH) -> DataFrame:
    """One row per document: its measures, ``base_failed`` and ``kept``.

    ``base_failed`` is the fixed rule (fewer than 50 words, or more than half of
    the words inside repeated windows). ``kept`` also asks that every measure, the
    logarithm of the number of words among them, lies within the fences of the
    document's language and source (see ``thresholds``); counts in ``FEW`` pass
    whatever their share. Null languages and sources are groups of their
    own. Empty and null texts fail the base rule. Repeated rows stay repeated.
    """
    rows = staged(measure(docs), "measures")
    bounds = thresholds(sketch(rows), least_rows, reach)
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    shares = _shares()
    inside = F.lit(True)
    for name in UPPER:
        within = shares[name] <= F.col(f"max_{name}")
        inside = inside & (within | (F.col(FEW[name][0]) <= FEW[name][1]) if name in FEW else within)
    for name in LOWER:
        inside = inside & (shares[name] >= F.col(f"min_{name}"))
    same = [rows[c].eqNullSafe(bounds[c]) for c in GROUP]
    return (rows.join(bounds, same, "left")
            .select("doc_id", *NAMES[:5], base.alias("base_failed"), (~base & F.coalesce(inside, F.lit(True))).alias("kept")))

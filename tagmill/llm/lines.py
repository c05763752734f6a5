"""Quality classifier: a linear-chain conditional random field over lines, aggregated to a document score."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.llm.common import crc, fraction_below
from tagmill.llm.text import pieces, sorted_distinct

SYMBOLS = b"#*$%&|<>@~^_=+\\/{}[]"
# Documents per label in the training sample, and lines of one document that are sent to the driver (evenly spread).
SAMPLE_DOCS, SAMPLE_LINES = 700, 32
THRESHOLD = 0.3
SHARES = 9
CUTS = np.array([0.02, 0.08, 0.2, 0.4, 0.7])
FEATURES = 1 + SHARES * (len(CUTS) + 1)


def _marks() -> np.ndarray:
    """Per byte value: upper case, lower case, digit, symbol, ! or ?, other ASCII mark, part of a wider character, blank."""
    table = np.zeros(256, np.uint8)
    for b in range(256):
        c = chr(b)
        table[b] = (6 if b >= 128 else 7 if b in b" \t\n\r\x0b\x0c" else 0 if c.isupper() else 1 if c.islower() else 2 if c.isdigit()
                    else 3 if b in SYMBOLS else 4 if c in "!?" else 5)
    return table


def line_shares(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines that have a word, over many texts: number of the text, visible bytes, shares.

    Lines end at ``\\n``. A text without words counts as one empty line.
    """
    joined = b"\n".join([*texts, b""])
    table, data = _marks(), np.frombuffer(joined, np.uint8)
    ends = np.flatnonzero(data == 10)
    text_ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    owner = np.searchsorted(text_ends, ends)
    kind = table[data]
    place = np.repeat(np.arange(len(ends)) * 8, np.diff(ends, prepend=-1))
    kinds = np.bincount(place + kind, minlength=8 * len(ends)).reshape(-1, 8)[:, :7]
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    found = []
    for part in pieces(joined):
        words = part.split()
        found.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
    ids = np.concatenate(found)
    blank = kind == 7
    first = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
    if len(blank) and not blank[0]:
        first = np.concatenate([[0], first])
    line = np.searchsorted(ends, first)
    words = np.bincount(line, minlength=len(ends))
    same = np.bincount(line[1:][(ids[1:] == ids[:-1]) & (line[1:] == line[:-1])], minlength=len(ends))
    distinct = np.bincount(sorted_distinct(line * max(1, len(numbers)) + ids) // max(1, len(numbers)), minlength=len(ends))
    # Empty lines of a text that has words are passed over; its last line stands for a text without any.
    filled = np.bincount(owner, weights=words, minlength=len(texts)) > 0
    kept = (words > 0) | (~filled[owner] & np.isin(ends, text_ends))
    owner, kinds, words, same, distinct = owner[kept], kinds[kept], words[kept], same[kept], distinct[kept]
    visible = kinds.sum(axis=1)
    of, letters, many = np.maximum(1, visible), np.maximum(1, kinds[:, 0] + kinds[:, 1]), np.maximum(1, words)
    shares = np.stack([kinds[:, 0] / letters, kinds[:, 2] / of, kinds[:, 3] * 4 / of, kinds[:, 4] * 4 / of, kinds[:, 5] / of,
                       same / many, np.where(words > 0, 1 - distinct / many, 0.0), np.minimum(1, of / many / 16),
                       np.minimum(1, words / 100)], axis=1)
    return owner, visible.astype(float), shares


def features(shares: np.ndarray) -> np.ndarray:
    """Indicator features of the shares, each cut into six ranges, and a constant."""
    cell = (shares[:, :, None] >= CUTS).sum(axis=2)
    hot = np.zeros((len(shares), SHARES, len(CUTS) + 1))
    np.put_along_axis(hot, cell[:, :, None], 1.0, axis=2)
    return np.concatenate([np.ones((len(shares), 1)), hot.reshape(len(shares), -1)], axis=1)


def neighbours(found: np.ndarray) -> np.ndarray:
    """Features of each line with those of the lines before and after (zeros at the ends)."""
    none = np.zeros((1, found.shape[1]))
    return np.concatenate([found, np.concatenate([none, found[:-1]]), np.concatenate([found[1:], none])], axis=1)


def marginals(energy: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability that each line is bad, and expected moves, by the forward-backward recursion.

    ``energy`` is the score of bad against good; ``moves[i, j]`` scores a step from tag i to j (0 good, 1 bad).
    """
    n, step = len(energy), np.exp(moves)
    ahead, behind = np.empty((n, 2)), np.ones((n, 2))
    own = np.stack([np.ones(n), np.exp(np.clip(energy, -30, 30))], axis=1)
    own /= own.sum(axis=1, keepdims=True)
    ahead[0] = own[0]
    for t in range(1, n):
        row = own[t] * (ahead[t - 1] @ step)
        ahead[t] = row / row.sum()
    for t in range(n - 2, -1, -1):
        row = step @ (own[t + 1] * behind[t + 1])
        behind[t] = row / row.sum()
    both = ahead * behind
    both /= both.sum(axis=1, keepdims=True)
    moved = np.zeros((2, 2))
    if n > 1:
        pairs = ahead[:-1, :, None] * step * (own[1:] * behind[1:])[:, None, :]
        moved = (pairs / pairs.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return both[:, 1], moved


def marginals_together(energy: np.ndarray, real: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``marginals`` of many documents at once; ``energy`` and ``real`` are documents by lines, padded at the end."""
    docs, n = energy.shape
    step = np.exp(moves)
    own = np.stack([np.ones((docs, n)), np.exp(np.clip(energy, -30, 30))], axis=2)
    own /= own.sum(axis=2, keepdims=True)
    ahead, behind = np.empty((docs, n, 2)), np.ones((docs, n, 2))
    ahead[:, 0] = own[:, 0]
    for t in range(1, n):
        row = own[:, t] * (ahead[:, t - 1] @ step)
        ahead[:, t] = row / row.sum(axis=1, keepdims=True)
    for t in range(n - 2, -1, -1):
        row = (own[:, t + 1] * behind[:, t + 1]) @ step.T
        behind[:, t] = np.where(real[:, t + 1, None], row / row.sum(axis=1, keepdims=True), 1.0)
    both = ahead * behind
    both /= both.sum(axis=2, keepdims=True)
    pairs = ahead[:, :-1, :, None] * step * (own[:, 1:] * behind[:, 1:])[:, :, None, :]
    pairs /= pairs.sum(axis=(2, 3), keepdims=True)
    return both[:, :, 1], (pairs * real[:, 1:, None, None]).sum(axis=(0, 1))


def bad_shares(texts: list[bytes], weights: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Length-weighted mean of the marginals of each text's lines.

    Texts are worked through side by side, longest first, so each step handles all texts that still have a line.
    """
    if not texts:
        return np.zeros(0)
    owner, lengths, shares = line_shares(texts)
    inputs = features(shares)
    # The weights of a line's own features and of those it shows to its neighbours.
    own, before, after = (inputs @ w for w in np.split(weights, 3))
    energy = own.copy()
    joined = owner[1:] == owner[:-1]
    energy[1:] += np.where(joined, before[:-1], 0.0)
    energy[:-1] += np.where(joined, after[1:], 0.0)
    sizes = np.bincount(owner, minlength=len(texts))
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    order = np.argsort(-sizes, kind="stable")
    active = np.searchsorted(-sizes[order], -np.arange(sizes.max()), side="left")
    step = np.exp(moves)
    chance = np.stack([np.ones(len(energy)), np.exp(np.clip(energy, -30, 30))], axis=1)
    chance /= chance.sum(axis=1, keepdims=True)
    ahead, behind = np.empty_like(chance), np.ones_like(chance)
    ahead[begin] = chance[begin]
    for t in range(1, sizes.max()):
        at = begin[order[:active[t]]] + t
        row = chance[at] * (ahead[at - 1] @ step)
        ahead[at] = row / row.sum(axis=1, keepdims=True)
    for t in range(sizes.max() - 1, 0, -1):
        at = begin[order[:active[t]]] + t
        row = (chance[at] * behind[at]) @ step.T
        behind[at - 1] = row / row.sum(axis=1, keepdims=True)
    both = ahead * behind
    bad = both[:, 1] / both.sum(axis=1)
    return np.bincount(owner, weights=bad * np.maximum(lengths, 1e-9)) / np.bincount(owner, weights=np.maximum(lengths, 1e-9))


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths, shares = [], []
        texts = [text or b"" for text in batch.column(1).to_pylist()]
        owner, size, found = line_shares(texts)
        for lines_ in np.split(np.arange(len(owner)), np.searchsorted(owner, np.arange(1, len(texts)))):
            some = lines_[np.unique(np.linspace(0, len(lines_) - 1, min(len(lines_), SAMPLE_LINES)).astype(int))]
            lengths.append(size[some].tolist())
            shares.append(found[some].ravel().tolist())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.list_(pa.float64())), pa.array(shares, pa.list_(pa.float64()))],
                                         names=["quality", "lengths", "shares"])


def _logistic(x: np.ndarray, yes: np.ndarray, weight: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> np.ndarray:
    data, theta = np.stack([x, np.ones_like(x)], axis=1), np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(data @ theta, -30, 30)))
        curve = (data * (weight * p * (1 - p))[:, None]).T @ data + ridge * np.eye(2)
        theta = theta + np.clip(np.linalg.solve(curve, data.T @ (weight * (yes - p)) - ridge * theta), -3, 3)
    return theta


def fit(sample: list[tuple[int, np.ndarray, np.ndarray]], prior: float, rounds: int = 3, steps: int = 40,
        rate: float = 0.2, decay: float = 1e-3) -> tuple:
    """Weights, moves and calibration from ``quality, lengths, shares`` per document.

    Only documents are labelled. Lines of good ones are good. Lines of bad ones begin as bad; after each round
    those that the field is sure are good (each bad document keeps its worst line bad) change their tag.
    ``prior`` is the share of good documents among all labelled ones; the sample is weighted back to it.
    """
    size = 3 * FEATURES
    weights, moves = np.zeros(size), np.zeros((2, 2))
    if len({q for q, _, _ in sample}) < 2:
        return weights, moves, np.array([0.0, 4.0 if prior > 0.5 else -4.0])
    inputs = [neighbours(features(shares)) for _, _, shares in sample]
    tags = [np.full(len(x), 1 - q, float) for (q, _, _), x in zip(sample, inputs, strict=True)]
    stacked = np.concatenate(inputs)
    sizes = np.array([len(x) for x in inputs])
    real = np.arange(sizes.max()) < sizes[:, None]
    for _ in range(rounds):
        flat = np.concatenate(tags)
        steps_of = np.zeros((2, 2))
        for tag in tags:
            np.add.at(steps_of, (tag[:-1].astype(int), tag[1:].astype(int)), 1)
        first, second = np.zeros(size + 4), np.zeros(size + 4)
        for step in range(1, steps + 1):
            energy = np.zeros(real.shape)
            energy[real] = stacked @ weights
            found, moved = marginals_together(energy, real, moves)
            bad = found[real]
            gradient = np.concatenate([stacked.T @ (flat - bad), (steps_of - moved).ravel()]) / len(sample)
            gradient -= decay * np.concatenate([weights, moves.ravel()])
            first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient ** 2
            change = rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
            weights, moves = weights + change[:size], moves + change[size:].reshape(2, 2)
        for i, (quality, _, _) in enumerate(sample):
            if not quality:
                bad = marginals(inputs[i] @ weights, moves)[0]
                tags[i] = (bad >= min(0.2, bad.max())).astype(float)
    energy = np.zeros(real.shape)
    energy[real] = stacked @ weights
    bad = np.where(real, marginals_together(energy, real, moves)[0], 0.0)
    size_of = np.zeros(real.shape)
    size_of[real] = np.maximum(1e-9, np.concatenate([lengths for _, lengths, _ in sample]))
    values = (bad * size_of).sum(axis=1) / size_of.sum(axis=1)
    quality = np.array([q for q, _, _ in sample], float)
    share = quality.mean()
    weight = np.where(quality > 0, prior / share, (1 - prior) / (1 - share))
    return weights, moves, _logistic(values, quality, weight)


def train(docs: DataFrame, labels: DataFrame, docs_per_label: int = SAMPLE_DOCS) -> tuple:
    """Fit on about ``docs_per_label`` documents of each quality, chosen by a hash of the id.

    Labels other than 0 and 1 are left out; of contradicting labels the lower
    one counts. Texts become line statistics where they lie.
    """
    known = (labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id")
             .agg(F.min("quality").cast("int").alias("__quality")))
    counts = {r[0]: r[1] for r in known.groupBy("__quality").agg(F.count("*").alias("n")).collect()}
    total = max(1, sum(counts.values()))
    chosen = F.lit(False)
    for quality, n in counts.items():
        chosen = F.when(F.col("__quality") == quality, fraction_below("doc_id", "lines", min(1.0, docs_per_label / n))).otherwise(chosen)
    # About twice docs_per_label ids, whatever the size of the tables.
    some = F.broadcast(known.filter(chosen))
    rows = (docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(some, "doc_id").select("__quality", "text")
            .mapInArrow(_sampled, "quality int, lengths array<double>, shares array<double>"))
    sample = [(r[0], np.array(r[1]), np.array(r[2]).reshape(-1, SHARES)) for r in rows.collect()]
    sample.sort(key=lambda s: (s[0], len(s[1]), s[1].tolist(), s[2].ravel().tolist()))
    return fit(sample, counts.get(1, 0) / total)


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, moves, calibration = shared.value
        for batch in batches:
            place = batch.schema.get_field_index("__text")
            values = bad_shares([text or b"" for text in batch.column(place).to_pylist()], weights, moves)
            scores = 1 / (1 + np.exp(-(values * calibration[0] + calibration[1])))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(batch.num_columns) if i != place], pa.array(scores, pa.float64())],
                                             names=[*[n for n in batch.schema.names if n != "__text"], "__score"])

    return run


def score(docs: DataFrame, model: tuple, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of each row and ``__score``, the estimated probability that its label is 1.

    Each text is scored by itself and whole; null and empty texts are one empty line. The model has a fixed size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col("text").cast("binary").alias("__text"))
    schema = ", ".join(f"`{c}` {dict(docs.dtypes)[c]}" for c in keep)
    return rows.mapInArrow(_scored(shared), f"{schema}, __score double")


def _held_out(folds: int):
    return F.pmod(crc(), F.lit(folds)) == 0


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted``; labels of held-out rows (CRC of the id 0 modulo ``folds``) are not used."""
    model = train(docs, labels.filter(~_held_out(folds)))
    return score(docs, model, ["doc_id"]).select("doc_id", _held_out(folds).alias("held_out"), F.col("__score").alias("score"),
                                                 (F.col("__score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = THRESHOLD) -> DataFrame:
    """The rows and columns of the documents that are not rejected."""
    model = train(docs, labels.filter(~_held_out(folds)))
    return score(docs, model, list(docs.columns)).filter(F.col("__score") >= threshold).select(*docs.columns)

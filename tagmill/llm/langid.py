"""Language identification with error-correcting output codes over binary n-gram classifiers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.llm.common import crc, fraction_below

CELLS, ORDERS = 1 << 15, (1, 2, 3)
UNKNOWN = "und"
# Bounds of the training sample: texts per language, languages, and n-grams per text sent to the driver.
SAMPLE_TEXTS, MOST_LANGUAGES = 300, 400
PART = 1 << 20
# Second-best language within this score of the best one: ambiguous.
MARGIN = 0.2
_MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def gram_cells(text: str) -> Iterator[np.ndarray]:
    """Hash cells of the character n-grams of a lower-cased text, in parts of bounded size.

    Everything but letters counts as one blank kind of character.
    """
    for at in range(0, len(text), PART):
        part = text[max(0, at - max(ORDERS) + 1):at + PART].lower()
        codes = np.frombuffer(part.encode("utf-32-le"), np.uint32).astype(np.uint64)
        # Below "A", and between and after the ASCII letters, nothing is a letter.
        codes[(codes < 97) | ((codes > 122) & (codes < 0xAA))] = 32
        hashed = np.zeros(len(codes), np.uint64)
        out = []
        for order in ORDERS:
            if order == 1:
                hashed = codes * _MULTIPLIERS[0]
            else:
                hashed = (hashed[:-1] ^ (hashed[:-1] >> np.uint64(29))) + codes[order - 1:] * _MULTIPLIERS[order - 1]
            mixed = (hashed ^ (hashed >> np.uint64(32))) * _MULTIPLIERS[1] >> np.uint64(64 - 15)
            out.append(mixed.astype(np.int64))
        yield np.concatenate(out)


def codewords(languages: int, seed: int = 7) -> np.ndarray:
    """One row of +1/-1 bits per language.

    Up to five languages: all ways to split them in two. More: of many random
    code books of ``max(15, 4 log2 n)`` bits the one with the largest smallest distance.
    """
    if languages <= 1:
        return np.ones((languages, 1))
    if languages <= 5:
        columns = [[1.0 if i == 0 or not split >> (i - 1) & 1 else -1.0 for i in range(languages)]
                   for split in range(1, 1 << (languages - 1))]
        return np.array(columns).T
    bits, random = max(15, int(4 * np.ceil(np.log2(languages)))), np.random.default_rng(seed)
    best, best_distance = None, -1
    for _ in range(200):
        book = random.choice([-1.0, 1.0], (languages, bits))
        # A bit on which all languages agree tells nothing.
        book[0, np.abs(book.sum(axis=0)) == languages] *= -1
        distance = int(((bits - book @ book.T) / 2 + bits * np.eye(languages)).min())
        if distance > best_distance:
            best, best_distance = book, distance
    return best


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells, counts = [], []
        for text in batch.column(1).to_pylist():
            total = np.zeros(CELLS, np.int64)
            for part in gram_cells(text or ""):
                total += np.bincount(part, minlength=CELLS)
            used = np.flatnonzero(total)
            cells.append(used.astype(np.int32))
            counts.append(total[used].astype(np.float32))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cells, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.float32()))],
                                         names=["lang", "cells", "counts"])


class Model:
    """Languages, codewords, one linear n-gram classifier per bit with its calibration and its weight."""

    def __init__(self, sample: list[tuple[str, np.ndarray, np.ndarray]]):
        self.languages = sorted({lang for lang, _, _ in sample})
        self.words = codewords(len(self.languages))
        bits = self.words.shape[1] if self.languages else 0
        self.weights = np.zeros((CELLS, bits), np.float32)
        self.slope, self.shift, self.trust = np.ones(bits), np.zeros(bits), np.ones(bits)
        if len(self.languages) < 2:
            return
        counts = np.zeros((len(self.languages), CELLS))
        for lang, cells, values in sample:
            # Each text counts once, however long it is.
            counts[self.languages.index(lang), cells] += values / values.sum()
        counts /= counts.sum(axis=1, keepdims=True)
        smooth = 0.05 / CELLS
        values = np.zeros((len(sample), bits))
        for bit in range(bits):
            yes, no = counts[self.words[:, bit] > 0].mean(axis=0), counts[self.words[:, bit] < 0].mean(axis=0)
            self.weights[:, bit] = np.log((yes + smooth) / (no + smooth))
        for i, (_, cells, seen) in enumerate(sample):
            values[i] = seen @ self.weights[cells] / seen.sum()
        side = self.words[[self.languages.index(lang) for lang, _, _ in sample]]
        for bit in range(bits):
            self.slope[bit], self.shift[bit] = _logistic(values[:, bit], side[:, bit] > 0)
            wrong = np.mean((self.slope[bit] * values[:, bit] + self.shift[bit] > 0) != (side[:, bit] > 0))
            # Bits that are often wrong weigh less in decoding.
            self.trust[bit] = max(0.05, 0.5 * np.log((1 - wrong + 1e-3) / (wrong + 1e-3)))
        self.trust /= self.trust.sum()

    def plain(self) -> tuple:
        return self.languages, self.words, self.weights, self.slope, self.shift, self.trust


def _logistic(x: np.ndarray, yes: np.ndarray, rounds: int = 60, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and shift of a one-dimensional logistic fit (Newton's method with a small ridge)."""
    scale = x.std() + 1e-9
    data = np.stack([x / scale, np.ones_like(x)], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(data @ theta, -30, 30)))
        gradient = data.T @ (yes - p) - ridge * theta
        curve = (data * (p * (1 - p))[:, None]).T @ data + ridge * np.eye(2)
        theta = theta + np.clip(np.linalg.solve(curve, gradient), -2, 2)
    return float(theta[0] / scale), float(theta[1])


def train(docs: DataFrame, texts: int = SAMPLE_TEXTS, most_languages: int = MOST_LANGUAGES) -> Model:
    """Fit on about ``texts`` texts per language of ``docs(doc_id, text, lang)``, chosen by a hash of the id.

    Rows without a language or without text are left out. Texts are turned into
    n-gram counts where they lie; the driver gets counts only.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).limit(most_languages + 1).collect()
    if len(counts) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    share = F.lit(False)
    for row in counts:
        share = F.when(F.col("lang") == row["lang"], fraction_below("doc_id", "lang", min(1.0, texts / row["n"]))).otherwise(share)
    rows = known.filter(share).select("lang", "text").mapInArrow(_counted, "lang string, cells array<int>, counts array<float>")
    sample = [(r[0], np.array(r[1], np.int64), np.array(r[2], np.float64)) for r in rows.collect() if r[1]]
    return Model(sorted(sample, key=lambda s: (s[0], len(s[1]), s[1].tolist())))


def _predicted(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, words, weights, slope, shift, trust = shared.value
        for batch in batches:
            predicted, scores, unsure = [], [], []
            for text in batch.column(1).to_pylist():
                if not text or not languages or not has_letter(text):
                    predicted.append(UNKNOWN)
                    scores.append(0.0)
                    unsure.append(True)
                    continue
                total, grams = np.zeros(words.shape[1]), 0
                for cells in gram_cells(text):
                    total += weights[cells].sum(axis=0, dtype=np.float64)
                    grams += len(cells)
                margin = slope * (total / grams) + shift
                # Logistic loss of each language's bits, weighted by how far a bit can be trusted.
                loss = np.logaddexp(0.0, -words * margin) @ trust
                share = np.exp(-(loss - loss.min()) * words.shape[1] / 2)
                share /= share.sum()
                best = int(np.argmin(loss))
                predicted.append(languages[best])
                scores.append(float(share[best]))
                unsure.append(bool(len(share) > 1 and np.sort(share)[-2] > share[best] - MARGIN))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(predicted, pa.string()), pa.array(scores, pa.float64()),
                                              pa.array(unsure, pa.bool_())], names=["doc_id", "lang_pred", "score", "ambiguous"])

    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous`` per row from the whole text alone.

    Null texts and texts without a letter get ``und`` and score 0. Ties go to the
    language that sorts first. The model has a fixed size per language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.plain())
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(_predicted(shared), f"doc_id {kind}, lang_pred string, score double, ambiguous boolean")


def identify(docs: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """Learn from the rows whose CRC of the id is not ``held_out`` modulo ``folds``; predict all of them."""
    fold = F.pmod(crc(), F.lit(folds)) == held_out
    found = predict(docs, train(docs.filter(~fold)))
    return found.select("doc_id", fold.alias("held_out"), "lang_pred", "score", "ambiguous")

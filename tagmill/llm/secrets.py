"""Secret scan: fixed patterns and a linear-chain conditional random field over tokens."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from bisect import bisect
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.llm.common import fraction_below

KINDS = ("assign", "access", "hex", "crf")
KEYWORDS = ("password", "passwd", "secret", "token", "api")
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGN, LEAST_ACCESS = 12, 18

TOKEN = re.compile(r"[\w+/.\-]+|[^\w\s+/.\-]")
OUT, BEGIN, IN = 0, 1, 2
# Bounds of the training sample: texts with and without a pattern, their length, tokens kept around a token of interest,
# and how often a secret or an ordinary word is rewritten.
SAMPLE_TEXTS, SAMPLE_LENGTH, WINDOW, CLEAN_WINDOWS, REWRITES = 500, 20_000, 4, 3, 4
# Ways to write a secret down which the patterns do not know; training puts the secrets of the sample into them.
FORMS = ("{name} = {v}", "{name}: {v}", '"{name}": "{v}"', "{name}='{v}'", "Authorization: Bearer {v}", "bearer {v}",
         "{scheme}://{user}:{v}@{host}/", "auth={v}", "-p {name}={v}")
FORM_NAMES = ("pwd", "private_key", "credential", "credentials", "auth", "access_key", "clientKey", "signing-key", "db.pwd")
ALPHABETS = ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "0123456789ABCDEF", "0123456789abcdef",
             "abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHabcdefgh0123456789+/")
CACHED_TOKENS, PART = 1 << 18, 1 << 21

NAMES = {name: i for i, name in enumerate(
    ("password passwd pwd secret token apikey api_key api key auth bearer credential credentials private access "
     "authorization client id user login").split(), 1)}
PUNCTUATION = {c: i for i, c in enumerate("=:\"'`,;()<>{}[]|#$@&*!?", len(NAMES) + 1)}
OTHER_MARK = len(NAMES) + len(PUNCTUATION) + 1
# A name made of several parts, one of which announces a secret, and a mark between such a name and what it names.
COMPOUND, CUED = OTHER_MARK + 1, OTHER_MARK + 2
_WORDS = CUED + 1
CUES = frozenset("password passwd pwd passphrase secret token apikey key auth bearer credential credentials private authorization".split())
CAMEL = re.compile(r"[a-z](?:Key|Secret|Token|Password|Passwd|Pwd|Credentials?|Auth)$")
# Kinds of characters (16) x length (7) x changes between letters and digits (4) x only hexadecimal digits (2).
CLASSES = _WORDS + 16 * 7 * 4 * 2
EDGE, FILES = CLASSES, 8
_LENGTHS = np.array([4, 8, 12, 16, 24, 40])


def token_class(token: str) -> int:
    """The shape of a token as one small number."""
    if len(token) == 1 and not token.isalnum():
        return PUNCTUATION.get(token, OTHER_MARK)
    named = NAMES.get(token.lower())
    if named:
        return named
    if len(token) <= 40 and (CAMEL.search(token) or not CUES.isdisjoint(re.split(r"[_.\-]+", token.lower())[:8])):
        return COMPOUND
    low = up = digit = other = False
    changes, before = 0, None
    for c in token:
        kind = c.isdigit()
        if kind:
            digit = True
        elif c.islower():
            low = True
        elif c.isupper():
            up = True
        else:
            other = True
        if before is not None and kind != before:
            changes += 1
        before = kind
    kinds = low + 2 * up + 4 * digit + 8 * other
    length = int(np.searchsorted(_LENGTHS, len(token), side="right"))
    turns = 0 if changes == 0 else 1 if changes <= 1 else 2 if changes <= 4 else 3
    only_hex = digit and all(c in "0123456789abcdefABCDEF" for c in token)
    return _WORDS + ((kinds * 7 + length) * 4 + turns) * 2 + only_hex


def _factors() -> np.ndarray:
    """Classes by features: each class itself for names and marks; for words their kinds of characters, length,
    changes, hexadecimal digits, and length with changes or kinds, so that unseen classes share what is known of their parts."""
    out = np.zeros((CLASSES + 1, _WORDS + 16 + 7 + 4 + 2 + 28 + 112 + 2))
    for c in range(_WORDS):
        out[c, c] = 1
    for c in range(_WORDS, CLASSES):
        rest, only_hex = divmod(c - _WORDS, 2)
        rest, turns = divmod(rest, 4)
        kinds, length = divmod(rest, 7)
        at = _WORDS
        for size, value in ((16, kinds), (7, length), (4, turns), (2, only_hex), (28, length * 4 + turns),
                            (112, kinds * 7 + length)):
            out[c, at + value] = 1
            at += size
        out[c, at] = 1
    out[EDGE, -1] = 1
    return out


_IS_CUE = np.zeros(CLASSES + 1, bool)
_IS_CUE[[COMPOUND, *(i for name, i in NAMES.items() if name in CUES or name == "api_key")]] = True
_IS_LINK = np.zeros(CLASSES + 1, bool)
_IS_LINK[[PUNCTUATION[c] for c in "=:\"'`"]] = True


def _cue(own: np.ndarray) -> np.ndarray:
    """Up to four marks after a name that announces a secret become ``CUED``, so what follows knows of the name."""
    spots = np.flatnonzero(_IS_LINK[own])
    spots = spots[spots > 0]
    for _ in range(4):
        before = own[spots - 1]
        told = _IS_CUE[before] | (before == CUED)
        own[spots[told]] = CUED
        spots = spots[~told]
        if not told.any():
            break
    return own


class WordClasses(dict):
    """Classes of the tokens of a word between blanks, remembered up to a bound."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHED_TOKENS:
            self.clear()
        value = tuple(token_class(t) for t in TOKEN.findall(word))
        if len(word) <= 64:
            self[word] = value
        return value


def text_classes(text: str, known: WordClasses) -> np.ndarray:
    """Classes of all tokens of a text in order; long texts are cut into words part by part."""
    out, at = [], 0
    while at < len(text):
        end = min(len(text), at + PART)
        while end < len(text) and not text[end].isspace():
            end += 1
        out.append(np.fromiter(chain.from_iterable(map(known.__getitem__, text[at:end].split())), np.int16))
        at = end
    return _cue(np.concatenate(out)) if out else np.zeros(0, np.int16)


def file_class(text: str) -> int:
    """How densely a file holds signs of code and settings: 8 classes."""
    size = max(1, len(text))
    marks = sum(map(text.count, "=:;{}<>"))
    breaks = text.count("\n")
    return int(marks * 200 > size) + 2 * int(marks * 50 > size) + 4 * int(breaks * 60 > size)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, kind, end`` of the fixed patterns, leftmost without overlap per kind."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def secret_values(text: str) -> list[tuple[int, int]]:
    """Where the secret itself stands in the base spans, merged."""
    parts = [(m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    parts += [(start, end) for start, kind, end in base_spans(text) if kind]
    return merged(parts)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def uncovered(start: int, end: int, covered: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The parts of a span outside of sorted spans."""
    for low, high in covered[max(0, bisect(covered, (start,)) - 1):]:
        if low >= end:
            break
        if high > start:
            if low > start:
                yield start, low
            start = high
    if start < end:
        yield start, end


def _rewritten(text: str, values: list[tuple[int, int]]) -> Iterator[tuple[str, int, int, bool]]:
    """Secrets of a text in other ways of writing, cut short or drawn anew, and ordinary words written like secrets.

    Words are also joined to long ones that nothing announces. Gives a passage with its surroundings, where the value
    stands, and whether it is a secret. Follows from the text alone.
    """
    draw = random.Random(zlib.crc32(text.encode("utf-8", "replace")))
    plain = re.findall(r"\b(?:[^\W\d_]{1,16}|[0-9]{1,5})\b", text) or ["none"]
    found = [(start, end, True) for start, end in values[:CLEAN_WINDOWS]]
    at = draw.randrange(len(text) + 1)
    for start, end, secret in [*found, (at, at, False)]:
        for _ in range(REWRITES if secret else 2 * REWRITES):
            form = draw.choice(FORMS)
            if not secret and draw.random() < 0.5:
                form, value = "{v}", draw.choice((str, str.upper, str.title))("".join(draw.choices(plain, k=draw.randint(2, 5))))
            elif not secret:
                value = draw.choice(plain)
            elif draw.random() < 0.4:
                value = text[start:end][:draw.randint(8, max(8, min(60, end - start)))]
            else:
                signs = draw.choice(ALPHABETS)
                value = "".join(draw.choice(signs) for _ in range(draw.randint(10, 40)))
            written = form.format(name=draw.choice(FORM_NAMES), v="\0", scheme=draw.choice(plain), user=draw.choice(plain),
                                  host=draw.choice(plain))
            head = text[max(0, start - 60):start] + " " + written[:written.index("\0")]
            yield head + value + written[written.index("\0") + 1:] + " " + text[end:end + 60], len(head), len(head) + len(value), secret


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Token windows for training: classes, tags, file class; around secrets and at regular places elsewhere."""
    classes = WordClasses()
    width = 2 * WINDOW + 1
    for batch in batches:
        rows, tags_of, files = [], [], []
        for text in batch.column(0).to_pylist():
            text = text or ""
            spots = list(TOKEN.finditer(text))
            if not spots:
                continue
            own = np.full(len(spots) + 2 * width, EDGE, np.int64)
            own[width:width + len(spots)] = text_classes(text, classes)
            tags = np.zeros(len(own), np.int64)
            starts = np.array([m.start() for m in spots])
            ends = np.array([m.end() for m in spots])
            marked = []
            for start, end in secret_values(text):
                first, last = int(np.searchsorted(ends, start, side="right")), int(np.searchsorted(starts, end))
                if last > first:
                    tags[width + first:width + last] = IN
                    tags[width + first] = BEGIN
                    marked.append(first)
            step = max(1, len(spots) // CLEAN_WINDOWS)
            # The longest tokens that are no secret are what is most easily taken for one.
            odd = [int(i) for i in np.argsort(starts - ends, kind="stable")[:4 * CLEAN_WINDOWS] if tags[width + i] == OUT][:CLEAN_WINDOWS]
            for middle in [*marked[:CLEAN_WINDOWS], *odd, *range(step // 2, len(spots), step)][:4 * CLEAN_WINDOWS]:
                rows.append(own[width + middle - WINDOW - 1:width + middle + WINDOW + 2].tolist())
                tags_of.append(tags[width + middle - WINDOW:width + middle + WINDOW + 1].tolist())
                files.append(file_class(text))
            for passage, start, end, secret in _rewritten(text, secret_values(text)):
                spots = list(TOKEN.finditer(passage))
                own = np.full(len(spots) + 2 * width, EDGE, np.int64)
                own[width:width + len(spots)] = text_classes(passage, classes)
                tags = np.zeros(len(own), np.int64)
                for from_, to in [*secret_values(passage), *([(start, end)] if secret else [])]:
                    inside = [width + i for i, m in enumerate(spots) if m.start() < to and m.end() > from_]
                    tags[inside] = IN
                    tags[inside[:1]] = BEGIN
                middle = next(i for i, m in enumerate(spots) if m.end() > start)
                rows.append(own[width + middle - WINDOW - 1:width + middle + WINDOW + 2].tolist())
                tags_of.append(tags[width + middle - WINDOW:width + middle + WINDOW + 1].tolist())
                files.append(file_class(text))
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int64())), pa.array(tags_of, pa.list_(pa.int64())),
                                          pa.array(files, pa.int64())], names=["classes", "tags", "file"])


def _chain(emission: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of tags and summed marginals of moves for sequences of equal length ``(batch, length, tags)``."""
    batch, length, tags = emission.shape
    forward, backward = np.zeros_like(emission), np.zeros_like(emission)

    def total(x, axis):
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    forward[:, 0] = emission[:, 0]
    for t in range(1, length):
        forward[:, t] = emission[:, t] + total(forward[:, t - 1, :, None] + moves, 1)
    for t in range(length - 2, -1, -1):
        backward[:, t] = total(moves + (emission[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
    whole = total(forward[:, -1], 1)
    tagged = np.exp(forward + backward - whole[:, None, None])
    moved = np.zeros((tags, tags))
    for t in range(1, length):
        moved += np.exp(forward[:, t - 1, :, None] + moves + (emission[:, t] + backward[:, t])[:, None, :]
                        - whole[:, None, None]).sum(axis=0)
    return tagged, moved


def fit(windows: list, steps: int = 150, rate: float = 0.25, decay: float = 1e-4) -> dict[str, np.ndarray]:
    """Weights by gradient ascent on the likelihood (Adam), from ``classes, tags, file`` windows.

    Without windows, or without a tagged one, the weights say "outside" everywhere.
    """
    factors = _factors()
    shapes = {"own": (factors.shape[1], 3), "before": (factors.shape[1], 3), "after": (factors.shape[1], 3), "file": (FILES, 3), "moves": (3, 3)}
    parts = {k: np.zeros(s) for k, s in shapes.items()}
    parts["file"][:, OUT] = 1.0
    parts["moves"][OUT, IN] = -2.0

    def tables() -> dict[str, np.ndarray]:
        return {k: factors @ v if k in ("own", "before", "after") else v for k, v in parts.items()}

    if not windows or not any(any(tags) for _, tags, _ in windows):
        parts["file"][:, OUT] = 9.0
        return tables()
    classes = np.array([w[0] for w in windows])
    tags = np.array([w[1] for w in windows])
    files = np.array([w[2] for w in windows])
    own, before, after = classes[:, 1:-1], classes[:, :-2], classes[:, 2:]
    gold = np.eye(3)[tags]
    gold_moves = np.zeros((3, 3))
    np.add.at(gold_moves, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
    first = {k: np.zeros_like(v) for k, v in parts.items()}
    second = {k: np.zeros_like(v) for k, v in parts.items()}
    scale = 1.0 / len(windows)
    for step in range(1, steps + 1):
        weights = tables()
        emission = weights["own"][own] + weights["before"][before] + weights["after"][after] + weights["file"][files][:, None]
        tagged, moved = _chain(emission, weights["moves"])
        missing = (gold - tagged) * scale
        grads = {"file": np.zeros((FILES, 3)), "moves": (gold_moves - moved) * scale}
        np.add.at(grads["file"], files, missing.sum(axis=1))
        for name, index in (("own", own), ("before", before), ("after", after)):
            seen = np.stack([np.bincount(index.ravel(), missing[:, :, tag].ravel(), CLASSES + 1) for tag in range(3)], axis=1)
            grads[name] = factors.T @ seen
        for name, grad in grads.items():
            grad = grad - decay * parts[name]
            first[name] = 0.9 * first[name] + 0.1 * grad
            second[name] = 0.99 * second[name] + 0.01 * grad ** 2
            parts[name] += rate * (first[name] / (1 - 0.9 ** step)) / (np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-8)
    return tables()


def train(docs: DataFrame, texts: int = SAMPLE_TEXTS, length: int = SAMPLE_LENGTH) -> dict[str, np.ndarray]:
    """Fit on a bounded sample: about ``texts`` texts that hold a base span and as many others.

    The base spans are the labels; the secrets in them are also put into other ways
    of writing (``FORMS``), cut short or drawn anew, and ordinary words are put there
    as what is no secret. Training texts have at most ``length`` characters, chosen by
    a hash of the id, so reruns agree; scanning has no bound.
    """
    pattern = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]|AKIA[A-Z0-9]{14}|[0-9a-f]{16}"
    marked = docs.filter(F.length("text") <= length).select("doc_id", F.col("text").rlike(pattern).alias("hit"))
    counts = {row["hit"]: row["n"] for row in marked.groupBy("hit").agg(F.count("*").alias("n")).collect()}
    share = {hit: min(1.0, texts / max(1, counts.get(hit, 0))) for hit in (True, False)}
    some = docs.filter(F.length("text") <= length).filter(
        F.when(F.col("text").rlike(pattern), fraction_below("doc_id", "crf", share[True]))
        .otherwise(fraction_below("doc_id", "crf", share[False])))
    # Bounded by the choice of texts: a text gives at most 4 * CLEAN_WINDOWS + (CLEAN_WINDOWS + 2) * REWRITES windows.
    found = some.select("text").mapInArrow(_windows, "classes array<bigint>, tags array<bigint>, file bigint").collect()
    return fit(sorted((list(r[0]), list(r[1]), r[2]) for r in found))


def _viterbi(emission: np.ndarray, moves: np.ndarray, before: int, after: int) -> list[int]:
    """Best tags of an island between a known tag before and after it (-1: none)."""
    score = emission[0] + (moves[before] if before >= 0 else 0)
    back = []
    for row in emission[1:]:
        paths = score[:, None] + moves
        back.append(paths.argmax(axis=0))
        score = paths.max(axis=0) + row
    if after >= 0:
        score = score + moves[:, after]
    tag = int(score.argmax())
    out = [tag]
    for choice in reversed(back):
        tag = int(choice[tag])
        out.append(tag)
    return out[::-1]


class Tagger:
    """Decoding of whole texts; exact, but cheap where a token cannot be part of a secret."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights, self.classes = weights, WordClasses()
        moves = weights["moves"]
        # What tagging a token "outside" instead can cost in moves at most; a larger lead decides it.
        gain = (moves - moves[:, [OUT]]).max(axis=0) + (moves - moves[[OUT]]).max(axis=1)
        self.lead = gain[1:]

    def tags(self, own: np.ndarray, file: int) -> tuple[np.ndarray, np.ndarray]:
        """Indices and tags of the tokens that are not outside."""
        w = self.weights
        padded = np.concatenate([[EDGE], own, [EDGE]]).astype(np.int16)
        emission = w["own"][own] + w["before"][padded[:-2]] + w["after"][padded[2:]] + w["file"][file]
        open_ = np.flatnonzero((emission[:, 1:] + self.lead).max(axis=1) >= emission[:, OUT])
        places, tags = [], []
        if len(open_):
            for island in np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1):
                first, last = island[0], island[-1]
                best = _viterbi(emission[first:last + 1], w["moves"], OUT if first else -1, OUT if last + 1 < len(own) else -1)
                for place, tag in zip(island, best, strict=True):
                    if tag != OUT:
                        places.append(place)
                        tags.append(tag)
        return np.array(places, np.int64), np.array(tags, np.int64)

    def spans(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """The base spans and what the field adds outside of them, sorted by start and kind."""
        own = text_classes(text, self.classes)
        if not len(own):
            return base
        places, tags = self.tags(own, file_class(text))
        if not len(places):
            return base
        wanted, at = set(places.tolist()), {}
        for i, m in enumerate(TOKEN.finditer(text)):
            if i in wanted:
                at[i] = (m.start(), m.end())
        added: list[list[int]] = []
        for place, tag in zip(places.tolist(), tags.tolist(), strict=True):
            start, end = at[place]
            if tag == IN and added and added[-1][2] == place - 1:
                added[-1][1:] = [end, place]
            else:
                added.append([start, end, place])
        covered = merged([(start, end) for start, _, end in base])
        free = [(start, 3, end) for first, last, _ in added for start, end in uncovered(first, last, covered)]
        return sorted(base + free)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _scanned(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value)
        for batch in batches:
            counts, digests, joined = [], [], []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                kinds = [kind for _, kind, _ in base]
                counts.append([kinds.count(k) for k in range(3)])
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                joined.append(_joined(tagger.spans(text or "", base)))
            table = np.array(counts, np.int64).reshape(len(counts), 3)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(table[:, k]) for k in range(3)],
                                              pa.array(digests, pa.string()), pa.array(joined, pa.string())],
                                             names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return run


def scan(docs: DataFrame, weights: dict[str, np.ndarray] | None = None) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of every whole text.

    ``spans`` holds ``kind:start:end`` in code points, end exclusive; ``crf``
    marks what the field finds beyond the patterns: of a span that a pattern covers
    in part, the parts outside. Null and empty texts have no spans. One row per input
    row, repeated rows included; an empty table gives none. The weights have a fixed size.
    """
    weights = train(docs) if weights is None else weights
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        _scanned(shared), f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")


def _redacted(shared, mark: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value)
        for batch in batches:
            texts = []
            for text in batch.column("text").to_pylist():
                spans = merged([(start, end) for start, _, end in tagger.spans(text, base_spans(text))]) if text else []
                parts, at = [], 0
                for start, end in spans:
                    parts += [text[at:start], mark]
                    at = end
                texts.append("".join(parts) + text[at:] if spans else text)
            place = batch.schema.get_field_index("text")
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, pa.string()))

    return run


def redact(docs: DataFrame, weights: dict[str, np.ndarray] | None = None, mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns with every span of ``text`` replaced by ``mark``."""
    weights = train(docs) if weights is None else weights
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    return docs.mapInArrow(_redacted(shared, mark), docs.schema)

"""Byte-level BPE: exact merges by longest matches and backtracking over compatible neighbours."""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from itertools import islice

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Pieces of at most this length are remembered, up to this many at a time in two halves, and answers on this many pairs
# of tokens: some 50 MB a worker, however much it reads.
CACHED_LENGTH, CACHED_PIECES, CACHED_PAIRS = 64, 1 << 18, 1 << 17
# Longer texts are cut into pieces lazily.
LONG_TEXT = 1 << 20
GROUP = 1 << 15


def read_ranks(path: str) -> list[bytes]:
    """Tokens in the order of their ranks from a rank file (base64 token, rank)."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    return tokens


def may_stand_together(left: int, right: int, tokens: list[bytes], rank_of: dict[bytes, int], lefts: array, rights: array) -> bool:
    """Whether BPE, given the bytes of both tokens, ends with exactly these two.

    Both tokens are taken apart, later merges first; if at some point the pieces
    that touch would have merged across the border before the next undoing, the
    pair cannot be what BPE produces.
    """
    bound = len(lefts)
    while True:
        across = rank_of.get(tokens[left] + tokens[right], bound)
        if across < bound and lefts[across] == left:
            return False
        undo_left = left > right
        for _ in range(2):
            if undo_left:
                whole, left = left, rights[left]
                if left != whole:
                    bound = whole
                    break
            else:
                whole, right = right, lefts[right]
                if right != whole:
                    bound = whole + 1
                    break
            undo_left = not undo_left
        else:
            return True


class Tables:
    """What encoding needs, made once from the ranks; plain data, so it can be broadcast."""

    def __init__(self, tokens: list[bytes]):
        rank_of = {token: i for i, token in enumerate(tokens)}
        if any(bytes([b]) not in rank_of for b in range(256)):
            raise ValueError("every single byte must be a token")
        self.automaton = ahocorasick.Automaton()
        for i, token in enumerate(tokens):
            self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.tokens, self.rank_of = tokens, rank_of
        # The longest token that is a proper prefix of a token.
        self.shorter = [next((rank_of[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in rank_of), -1) for t in tokens]
        # The two tokens that merge into a token; itself twice if none do.
        self.lefts, self.rights = array("i"), array("i")
        for i, token in enumerate(tokens):
            self.lefts.append(i)
            self.rights.append(i)
            left = self.shorter[i]
            while left >= 0:
                right = rank_of.get(token[len(tokens[left]):], i)
                if left < i and right < i and may_stand_together(left, right, tokens, rank_of, self.lefts, self.rights):
                    self.lefts[i], self.rights[i] = left, right
                    break
                left = self.shorter[left]

    def plain(self) -> tuple:
        """Plain values only. The three empty memos at the end live as long as a worker keeps the broadcast."""
        return (self.automaton, self.tokens, self.rank_of, self.shorter, self.lefts, self.rights,
                [len(t) for t in self.tokens], {}, {}, {})


class Codec:
    """Encode and decode with the tables; one per task."""

    def __init__(self, plain: tuple, pattern: str):
        (self.automaton, self.tokens, self.rank_of, self.shorter, self.lefts, self.rights, self.sizes, self.fits,
         self.known, self.older) = plain
        self.pattern = regex.compile(pattern)
        # Remembered ids are packed: two bytes each, or four for larger vocabularies.
        self.code = "H" if len(self.tokens) <= 1 << 16 else "I"

    def _fit(self, left: int, right: int) -> bool:
        if len(self.fits) >= CACHED_PAIRS:
            self.fits.clear()
        fit = may_stand_together(left, right, self.tokens, self.rank_of, self.lefts, self.rights)
        self.fits[left << 32 | right] = fit
        return fit

    def encode_bytes(self, data: bytes) -> list[int]:
        """Ids of one piece. Each position is given up at most once, so time is linear in the length."""
        whole = self.rank_of.get(data)
        if whole is not None:
            return [whole]
        size, sizes, shorter, fits = len(data), self.sizes, self.shorter, self.fits
        longest = [-1] * (size + 1)
        for end, token in self.automaton.iter(data.decode("latin-1")):
            # Matches come in order of their ends, so the last one of a start is its longest.
            longest[end + 1 - sizes[token]] = token
        alive = bytearray(b"\1") * (size + 1)
        out: list[int] = []
        at, token, last = 0, longest[0], -1
        while at < size:
            end = at + sizes[token]
            if alive[end]:
                fit = last < 0 or fits.get(last << 32 | token)
                if fit is None:
                    fit = self._fit(last, token)
                if fit:
                    out.append(token)
                    at, last, token = end, token, longest[end]
                    continue
            token = shorter[token]
            while token < 0:
                # No token fits here: this position is no border; shorten the token before.
                alive[at] = 0
                token = out.pop()
                at -= sizes[token]
                token = shorter[token]
                last = out[-1] if out else -1
        return out

    def _piece(self, piece: str) -> bytes:
        """Packed ids of a piece. Once half the memo is full it becomes the older half, whose pieces are kept if met again."""
        ids = self.known.get(piece)
        if ids is None:
            ids = self.older.get(piece)
            if ids is None:
                ids = array(self.code, self.encode_bytes(piece.encode())).tobytes()
            if len(piece) <= CACHED_LENGTH:
                if len(self.known) >= CACHED_PIECES // 2:
                    self.older.clear()
                    self.older.update(self.known)
                    self.known.clear()
                self.known[piece] = ids
        return ids

    def groups(self, text: str) -> Iterator[list[int]]:
        """Ids of a text in lists of bounded size (but for single huge pieces)."""
        if len(text) <= LONG_TEXT:
            found = iter([self.pattern.findall(text)])
        else:
            matches = self.pattern.finditer(text)
            found = iter(lambda: [m.group() for m in islice(matches, GROUP)], [])
        for some in found:
            ids = list(map(self.known.get, some))
            if None in ids:
                ids = [self._piece(piece) if known is None else known for piece, known in zip(some, ids, strict=True)]
            yield array(self.code, b"".join(ids)).tolist()

    def encode(self, text: str) -> list[int]:
        return [i for ids in self.groups(text) for i in ids]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def _digests(shared, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value, pattern)
        digits = [str(i) for i in range(len(codec.tokens))]
        for batch in batches:
            counts, encoded, decoded = [], [], []
            for text in batch.column(1):
                n, ids_hash, bytes_hash, first = 0, hashlib.sha256(), hashlib.sha256(), True
                for ids in codec.groups(text.as_py() or ""):
                    if ids:
                        ids_hash.update(("" if first else " ").encode() + " ".join(map(digits.__getitem__, ids)).encode())
                        bytes_hash.update(codec.decode(ids))
                        n, first = n + len(ids), False
                counts.append(n)
                encoded.append(ids_hash.hexdigest())
                decoded.append(bytes_hash.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _encoded(shared, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value, pattern)
        for batch in batches:
            ids = [codec.encode(text.as_py() or "") for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return run


def _decoded(shared, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value, pattern)
        for batch in batches:
            data = [codec.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["doc_id", "data"])

    return run


def _apply(df: DataFrame, column: str, work, schema: str, ranks: str, pattern: str) -> DataFrame:
    # The tables are built from one vocabulary file and do not grow with the data.
    shared = df.sparkSession.sparkContext.broadcast(Tables(read_ranks(ranks)).plain())
    kind = dict(df.dtypes)["doc_id"]
    return df.select("doc_id", F.col(column)).mapInArrow(work(shared, pattern), f"doc_id {kind}, {schema}")


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``doc_id, ids``: each match of ``pattern`` in ``text`` is encoded by itself, without special tokens.

    A null or empty text gives no ids. One row per input row; rows are neither moved nor grouped.
    """
    return _apply(docs, "text", _encoded, "ids array<int>", ranks, pattern)


def decode(rows: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``doc_id, data``: the bytes of ``ids``; null ids give no bytes."""
    return _apply(rows, "ids", _decoded, "data binary", ranks, pattern)


def digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Encode every text, decode its ids again, and report counts and digests of both.

    Long texts go through in groups of ids, so only one text and one group are held.
    """
    return _apply(docs, "text", _digests, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", ranks, pattern)

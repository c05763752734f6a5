"""Fowler-Noll-Vo string hashes of any standard width, and stable hash buckets."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The primes and starting values of the six standard widths.
FNV_PRIMES = {
    32: 0x1000193,
    64: 0x100000001b3,
    128: 0x1000000000000000000013b,
    256: 0x1000000000000000000000000000000000000000163,
    512: 0x100000000000000000000000000000000000000000000000000000000000000000000000000000000000157,
    1024: int(
        "1000000000000000000000000000000000000000000000000000000000000000000000000000000000000000000000000000"
        "0000000000000000000000000000000000000000000000000000000000000000000018d", 16),
}
FNV_STARTS = {
    32: 0x811c9dc5,
    64: 0xcbf29ce484222325,
    128: 0x6c62272e07bb014262b821756295c58d,
    256: 0xdd268dbcaac550362d98c384c4e576ccc8b1536847b6bbb31023b4c8caee0535,
    512: int(
        "b86db0b1171f4416dca1e50f309990acac87d059c90000000000000000000d21e948f68a34c192f62ea79bc942dbe7ce1820"
        "36415f56e34bac982aac4afe9fd9", 16),
    1024: int(
        "5f7a76758ecc4d32e56d5a591028b74b29fc4223fdada16c3bf34eda3674da9a21d900000000000000000000000000000000"
        "0000000000000000000000000000000000000000000000000000000000000000000004c6d7eb6e73802734510a555f256cc0"
        "05ae556bde8cc9c6a93b21aff4b16c71ee90b3", 16),
}
# Texts folded in step, and how many must be left for that to pay; longer ones are finished one by one.
TOGETHER, FEW = 4096, 4


def width_or_default(bits: int) -> int:
    """A width without its own prime is hashed at 64 bits."""
    return bits if bits in FNV_PRIMES else 64


def offset_basis(bits: int) -> int:
    return FNV_STARTS[bits]


def folder(bits: int, variant: str = "1a") -> Callable[[list[str]], np.ndarray]:
    """Function from texts to the hashes of their UTF-16 code units, as rows of little-endian bytes.

    All texts are folded together, one code unit of each at a time, on 32-bit limbs. The primes are a
    power of two plus a small factor, so a product is a shift and a product by that factor. The result
    refers to nothing but its own values, so it travels to workers that do not have this package.
    """
    bits = width_or_default(bits)
    factor, start, limbs, low = FNV_PRIMES[bits], FNV_STARTS[bits], bits // 32, np.uint64(0xFFFFFFFF)
    power = factor.bit_length() - 1
    small, (skip, shift) = np.uint64(factor - (1 << power)), divmod(power, 32)
    left, right = np.uint64(shift), np.uint64(32 - shift)
    xor_first, mask, together, few = variant == "1a", (1 << bits) - 1, TOGETHER, FEW

    def step(h: np.ndarray, units: np.ndarray) -> np.ndarray:
        if xor_first:
            h[0] ^= units
        out = h * small
        out[skip:] += (h[:limbs - skip] << left) & low
        out[skip + 1:] += h[:max(0, limbs - skip - 1)] >> right
        for i in range(limbs - 1):
            out[i + 1] += out[i] >> np.uint64(32)
        out &= low
        if not xor_first:
            out[0] ^= units
        return out

    def finish(value: int, units: list[int]) -> int:
        for unit in units:
            value = (value ^ unit) * factor & mask if xor_first else (value * factor & mask) ^ unit
        return value

    def some(texts: list[str]) -> np.ndarray:
        units = [np.frombuffer(t.encode("utf-16-le", "surrogatepass"), "<u2") for t in texts]
        sizes = np.array([len(u) for u in units])
        order = np.argsort(-sizes, kind="stable")
        flat, begins = np.concatenate(units).astype(np.uint64), (np.cumsum(sizes) - sizes)[order]
        longest_first = sizes[order]
        state = np.tile(np.array([start >> 32 * i & 0xFFFFFFFF for i in range(limbs)], np.uint64)[:, None], len(texts))
        at, active = 0, int((sizes > 0).sum())
        while active >= few:
            state[:, :active] = step(state[:, :active], flat[begins[:active] + at])
            at += 1
            active = int(np.searchsorted(-longest_first[:active], -at, side="left"))
        for i in range(active):
            value = finish(sum(int(x) << 32 * k for k, x in enumerate(state[:, i])), units[order[i]][at:].tolist())
            state[:, i] = [value >> 32 * k & 0xFFFFFFFF for k in range(limbs)]
        out = np.empty((len(texts), limbs), "<u4")
        out[order] = state.T
        return out.view(np.uint8)

    def fold(texts: list[str]) -> np.ndarray:
        parts = [some(texts[i:i + together]) for i in range(0, len(texts), together)]
        return np.concatenate(parts) if parts else np.empty((0, bits // 8), np.uint8)

    return fold


def fnv_value(text: str, bits: int, variant: str = "1a") -> int:
    """Hash of one text."""
    return int.from_bytes(folder(bits, variant)([text])[0].tobytes(), "little")


def fnv(c: Column | str, bits: int = 64, variant: str = "1a") -> Column:
    """Column of hashes as fixed-width big-endian bytes; each text of a batch is hashed once."""
    fold = folder(bits, variant)

    @F.pandas_udf("binary")
    def hashed(texts: pd.Series) -> pd.Series:
        codes, distinct = pd.factorize(texts)
        values = [row.tobytes() for row in fold(list(distinct))[:, ::-1]]
        return pd.Series([values[i] if i >= 0 else None for i in codes], dtype=object)

    return hashed(F.col(c) if isinstance(c, str) else c)


def hash_hex(key: Column | str, seed: int | str) -> Column:
    """Hexadecimal MD5 of ``seed:key``: same value on every engine, partitioning and run."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def unit_interval(key: Column | str, seed: int | str) -> Column:
    """Repeatable number in [0, 1) derived from the key; independent of partitioning."""
    return F.conv(F.substring(hash_hex(key, seed), 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))
